"""Live gap detection: per-symbol state over micro-batches.

State per symbol: the last tick time and the distinct times of the activity window. Rows of a batch
are ordered by time first; a tick at or before the last time changes nothing, so late data never
withdraws a gap. State moves only with a committed micro-batch. The nightly batch form
(``operators.gaps.hard_gaps``) is the corrected truth for late data.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..params import QualityParams
from ..schema import GAPS, GAP_COLUMNS


def session_of(ts_ms: np.ndarray, params: QualityParams) -> np.ndarray:
    """Session index of each time, -1 for none."""
    local = pd.to_datetime(ts_ms, unit="ms", utc=True).tz_convert(params.tz)
    second = (local.hour * 3600 + local.minute * 60 + local.second).to_numpy()
    index = np.full(len(ts_ms), -1)
    for i, s in reversed(list(enumerate(params.session_list))):
        index[(second >= s.start_sec) & (second < s.end_sec)] = i
    index[(local.weekday >= 5)] = -1
    return index


def detect(
    recent: np.ndarray, fresh: pd.DataFrame, params: QualityParams
) -> tuple[pd.DataFrame, np.ndarray]:
    """Gaps among ``fresh`` (time-ordered distinct ``ts_ms`` with ``trading_day``) after ``recent``,
    and the new window of times. ``recent`` ends with the last known time."""
    if len(recent):
        fresh = fresh[fresh["ts_ms"] > recent[-1]]
    new = fresh["ts_ms"].to_numpy(dtype=np.int64)
    if not len(new):
        return pd.DataFrame(columns=["trading_day", "prev", "curr", "count", "session"]), recent
    times = np.concatenate([recent, new])
    at = np.arange(len(recent), len(times))
    window = params.window_ms
    count = at - np.searchsorted(times, new - window, side="left") + 1
    has_prev = at > 0
    prev = times[np.maximum(at - 1, 0)]
    hit = has_prev & (count >= params.active_min_ticks)
    hit &= (new - prev) / 1000.0 > params.gap_threshold_sec
    where = np.flatnonzero(hit)
    left, right = session_of(prev[where], params), session_of(new[where], params)
    same = (left >= 0) & (left == right)
    where, right = where[same], right[same]
    found = pd.DataFrame(
        {
            "trading_day": fresh["trading_day"].to_numpy()[where],
            "prev": prev[where],
            "curr": new[where],
            "count": count[where],
            "session": right,
        }
    )
    return found, times[times >= times[-1] - window]


def _first_per_time(parts: Iterator[pd.DataFrame]) -> tuple[pd.DataFrame, int]:
    """One row per time of a micro-batch, the lowest seq, reduced part by part; and the largest receive
    time."""
    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values(["ts_ms", "seq"], na_position="first", kind="stable")
        return ordered.drop_duplicates("ts_ms")

    kept, received = [], 0
    for pdf in parts:
        received = max(received, int(pdf["recv_ts_ms"].max()))
        kept.append(first(pdf))
    return first(pd.concat(kept)), received


class GapProcessor(StatefulProcessor):
    def __init__(self, params: QualityParams):
        self.params = params

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.window = handle.getValueState("window", "times binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        p = self.params
        known = self.window.get() if self.window.exists() else None
        recent = np.frombuffer(known[0], dtype=np.int64) if known else np.empty(0, np.int64)
        fresh, received = _first_per_time(rows)
        found, window = detect(recent, fresh, p)
        if len(window):
            self.window.update((window.tobytes(),))
        if not len(found):
            return
        labels = [s.label for s in p.session_list]
        meta = [
            json.dumps(
                {
                    "prev_ts_ms": int(r.prev),
                    "curr_ts_ms": int(r.curr),
                    "gap_threshold_sec": float(p.gap_threshold_sec),
                    "active_window_sec": int(p.active_window_sec),
                    "active_min_ticks": int(p.active_min_ticks),
                    "active_count": int(r.count_),
                    "session": labels[r.session],
                },
                separators=(",", ":"),
            )
            for r in found.rename(columns={"count": "count_"}).itertuples()
        ]
        yield pd.DataFrame(
            {
                "trading_day": found["trading_day"],
                "symbol": key[0],
                "gap_start_ts_ms": found["prev"].astype("int64"),
                "gap_end_ts_ms": found["curr"].astype("int64"),
                "gap_sec": ((found["curr"] - found["prev"]) / 1000.0).astype(float).round(3),
                "detected_at_ms": received,
                "reason": "hard_gap",
                "meta_json": meta,
            }
        )[GAP_COLUMNS]

    def close(self) -> None:
        pass


def stream_gaps(ticks: DataFrame, params: QualityParams) -> DataFrame:
    """A stream of GAPS rows. Only the needed columns travel to the state operator. A gap is detected at
    the largest receive time of its symbol's rows in the micro-batch."""
    return (
        ticks.where(F.coalesce("symbol", F.lit("")) != "")
        .select("symbol", "ts_ms", "trading_day", "seq", F.coalesce("recv_ts_ms", F.lit(0)).alias("recv_ts_ms"))
        .groupBy("symbol")
        .transformWithStateInPandas(
            GapProcessor(params), GAPS, outputMode="Append", timeMode="None"
        )
    )
