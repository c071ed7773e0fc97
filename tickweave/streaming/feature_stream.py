"""Live minute features: the batch form's columns from a tick stream, by state per symbol and day.

State is the last tick's position and price, the sign of the last price move, and the sums of the open
bucket; no tick is buffered. Every micro-batch emits the buckets it touched, the open one included, with a
rising ``revision``; readers keep the newest revision of a bucket, so nothing waits for a watermark and
nothing is left out at the end. A tick that sorts before one already handled is not added; ``late_ticks``
counts such ticks of the symbol and day so far. ``operators.features.minute_features`` is the corrected
truth for late data.

With ``late_ms`` the state of a symbol and day goes once the watermark has passed the end of the local day of
its last tick, so a query that runs for ever holds the open days only. Ticks that come too late to be added,
by their order or because their day is closed, then come out as rows with a ``late`` tick.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..params import MicroParams
from .closing import Closing, day_end, on_event_time

FEATURES = (
    "ts_min_ms bigint, symbol string, trading_day string, ticks bigint, volume bigint, turnover double, "
    "open double, high double, low double, close double, buy_volume bigint, sell_volume bigint, "
    "imbalance double, abs_return double, price_change double, impact double, jump_count bigint, "
    "revision bigint, late_ticks bigint"
)
LATE = "late struct<ts_ms: bigint, seq: bigint, price: double, volume: bigint, turnover: double, direction: string>"
_TICK = ("ts_ms", "seq", "price", "volume", "turnover", "direction")
_NAMES = [part.split()[0] for part in FEATURES.split(", ")]
_SUMS = ("ticks", "volume", "turnover", "buy_volume", "sell_volume", "jump_count")


def bucket_rows(state: dict, ticks: pd.DataFrame, params: MicroParams) -> pd.DataFrame:
    """Sums of the buckets that some ordered ticks touch, the open bucket's earlier part included.

    ``state`` (``last``: time, seq, price and volume of the last tick; ``sign``; ``bucket``) moves on.
    """
    last = state.get("last")
    price = ticks["price"].to_numpy(float)
    at = ticks["ts_ms"].to_numpy(np.int64)
    before = np.concatenate([[last[2] if last else np.nan], price[:-1]])
    before_at = np.concatenate([[last[0] if last else -1], at[:-1]])
    step = price - before
    move = pd.Series(np.where(np.isnan(step) | (step == 0), np.nan, np.sign(step)))
    sign = move.ffill().fillna(state.get("sign") or np.nan).to_numpy()
    bucket = at // params.bucket_ms * params.bucket_ms
    jump = (np.abs(step) >= params.jump_ticks * params.tick_size - params.eps) & (before_at >= bucket)
    volume = ticks["volume"].fillna(0).to_numpy(np.int64)
    known = ticks["direction"].isin(["BUY", "SELL"]).to_numpy()
    side = np.where(known, np.where(ticks["direction"] == "BUY", 1.0, -1.0), sign)
    turnover = ticks["turnover"].to_numpy(float)
    rows = pd.DataFrame(
        {
            "ts_min_ms": bucket,
            "ticks": 1,
            "volume": volume,
            "turnover": np.where(np.isnan(turnover), price * volume, turnover),
            "price": price,
            "buy_volume": np.where(side > 0, volume, 0),
            "sell_volume": np.where(side < 0, volume, 0),
            "jump_count": jump.astype(np.int64),
        }
    )
    by = rows.groupby("ts_min_ms", sort=True)
    out = by[list(_SUMS)].sum()
    out["open"], out["high"] = by["price"].first(), by["price"].max()
    out["low"], out["close"] = by["price"].min(), by["price"].last()
    out = out.reset_index()
    started = state.get("bucket")
    if started and started["ts_min_ms"] == out.loc[0, "ts_min_ms"]:
        for name in _SUMS:
            out.loc[0, name] += started[name]
        out.loc[0, "open"] = started["open"]
        out.loc[0, "high"] = max(out.loc[0, "high"], started["high"])
        out.loc[0, "low"] = min(out.loc[0, "low"], started["low"])
    newest = out.iloc[-1]
    state["bucket"] = {k: float(v) if k in ("turnover", "open", "high", "low", "close") else int(v)
                       for k, v in newest.items()}
    end = ticks.iloc[-1]
    state["last"] = _place(end)
    state["sign"] = None if np.isnan(sign[-1]) else float(sign[-1])
    return out


def _place(tick: pd.Series) -> list:
    seq, volume = tick["seq"], tick["volume"]
    return [
        int(tick["ts_ms"]), -1 if pd.isna(seq) else int(seq), float(tick["price"]),
        -1 if pd.isna(volume) else int(volume),
    ]


class FeatureProcessor(StatefulProcessor):
    def __init__(self, params: MicroParams, closing: bool = False):
        self.params = params
        self.closing = closing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("features", "body string")
        self.timer = Closing(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stored = self.state.get() if self.state.exists() else None
        state = json.loads(stored[0]) if stored else {"revision": 0, "late": 0}
        ticks = pd.concat(list(rows))
        if self.closing:
            closed = day_end(ticks["ts_ms"], self.params.tz) <= timerValues.getCurrentWatermarkInMs()
            if closed.any():
                yield self._late(key, ticks[closed])
                state["late"] += int(closed.sum())
                ticks = ticks[~closed]
        if not len(ticks):
            if stored:
                self.state.update((json.dumps(state),))
            return
        ticks = ticks.assign(_seq=ticks["seq"].fillna(-1), _volume=ticks["volume"].fillna(-1))
        ticks = ticks.sort_values(["ts_ms", "_seq", "price", "_volume"], kind="stable")
        if "last" in state:
            place = list(zip(ticks["ts_ms"], ticks["_seq"], ticks["price"], ticks["_volume"]))
            fresh = np.array([list(t) >= state["last"] for t in place], dtype=bool)
            state["late"] += int((~fresh).sum())
            if self.closing and not fresh.all():
                yield self._late(key, ticks[~fresh])
            ticks = ticks[fresh]
        state["revision"] += 1
        out = bucket_rows(state, ticks, self.params) if len(ticks) else None
        if self.closing and out is not None:
            until = int(day_end(np.array([state["last"][0]]), self.params.tz)[0])
            self.timer.move(state.get("until"), until)
            state["until"] = until
        self.state.update((json.dumps(state),))
        if out is not None:
            yield self._features(key, out, state)

    def _features(self, key, out: pd.DataFrame, state: dict) -> pd.DataFrame:
        eps = self.params.eps
        change = out["close"] - out["open"]
        signed, both = out["buy_volume"] - out["sell_volume"], out["buy_volume"] + out["sell_volume"]
        found = out.assign(
            symbol=key[0],
            trading_day=key[1],
            imbalance=signed / (both + eps),
            abs_return=change.abs() / out["open"],
            price_change=change,
            impact=change.abs() / (out["volume"] + eps),
            revision=state["revision"],
            late_ticks=state["late"],
        )[_NAMES]
        return found.assign(late=None) if self.closing else found

    def _late(self, key, ticks: pd.DataFrame) -> pd.DataFrame:
        """Ticks that are not added, each as a row."""
        plain = ticks[list(_TICK)].astype(object).where(ticks[list(_TICK)].notna(), None)
        late = [dict(zip(_TICK, row)) for row in plain.itertuples(index=False, name=None)]
        bucket = ticks["ts_ms"].to_numpy() // self.params.bucket_ms * self.params.bucket_ms
        rows = pd.DataFrame({"ts_min_ms": bucket, "symbol": key[0], "trading_day": key[1], "late": late})
        return rows.reindex(columns=[*_NAMES, "late"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Remove the state of a closed symbol and day; its rows are all out already."""
        self.state.clear()
        yield pd.DataFrame(columns=[*_NAMES, "late"])

    def close(self) -> None:
        pass


def stream_features(ticks: DataFrame, params: MicroParams, late_ms: int | None = None) -> DataFrame:
    """A stream of bucket rows with revisions; only the needed columns reach the state operator.

    With ``late_ms`` there is a ``late`` column too: ``added`` and ``late_ticks`` tell the rows apart.
    """
    rows = ticks.where(F.col("price").isNotNull())
    if late_ms is not None:
        rows = on_event_time(rows.where(F.col("ts_ms").isNotNull()), "ts_ms", late_ms)
    grouped = rows.select("symbol", "trading_day", *_TICK).groupBy("symbol", "trading_day")
    return grouped.transformWithStateInPandas(
        FeatureProcessor(params, late_ms is not None),
        FEATURES if late_ms is None else f"{FEATURES}, {LATE}",
        outputMode="Append",
        timeMode="None" if late_ms is None else "EventTime",
    )


def added(rows: DataFrame) -> DataFrame:
    """The bucket rows of a stream with late ticks."""
    return rows.where("late IS NULL").drop("late")


def late_ticks(rows: DataFrame) -> DataFrame:
    """The ticks that came too late to be added."""
    return rows.where("late IS NOT NULL").select("symbol", "trading_day", "late.*")


def newest_revisions(rows: DataFrame) -> DataFrame:
    """Each bucket as last emitted."""
    key = ["symbol", "trading_day", "ts_min_ms"]
    newest = Window.partitionBy(*key).orderBy(F.col("revision").desc())
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
