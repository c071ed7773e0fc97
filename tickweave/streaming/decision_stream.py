"""Streaming form of the ordered decisions: the folds of ``operators.folds`` on keyed state."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.folds import (
    ALERT_KEYS,
    AdmissionFold,
    AlertFold,
    CooldownFold,
    HealthEmissionFold,
    _none,
    named_alerts,
)
from ..params import HealthParams
from .closing import Closing, on_event_time


class FoldProcessor(StatefulProcessor):
    """Orders a key's rows of the micro-batch by time and feeds them to the fold.

    ``ttl_ms`` drops keys that have been idle, for keys that carry a day. It runs on processing time,
    which keeps a query busy, so it is for continuous triggers only. With ``closing`` the state of a key
    goes once the watermark has passed the time from which the fold says that it is as good as new
    (``until``), or, where the fold says nothing, ``keep_ms`` after its last row.
    """

    def __init__(
        self, fold, time: str, ties: Sequence[str], columns, ttl_ms: int | None = None,
        closing: bool = False, keep_ms: int | None = None,
    ):
        self.fold = fold
        self.order = [time, *ties]
        self.columns = list(columns)
        self.ttl_ms = ttl_ms
        self.closing = closing
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("fold", "body string, until long", ttlDurationMs=self.ttl_ms)
        self.timer = Closing(handle)

    def _until(self, state: dict, last: int) -> int | None:
        if hasattr(self.fold, "until"):
            return self.fold.until(state)
        return None if self.keep_ms is None else last + self.keep_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stored = self.state.get() if self.state.exists() else None
        state = json.loads(stored[0]) if stored else self.fold.start()
        pdf = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        fields = self.fold.fields
        args = list(zip(*[pdf[f] for f in fields])) if fields else [()] * len(pdf)
        outs = [
            self.fold.step(state, int(at), tuple(_none(v) for v in row))
            for at, row in zip(pdf[self.order[0]], args)
        ]
        until = self._until(state, int(pdf[self.order[0]].iloc[-1])) if self.closing else None
        if self.closing:
            self.timer.move(stored[1] if stored else None, until)
        self.state.update((json.dumps(state), until))
        yield pd.concat([pdf[self.columns], self._results(outs, pdf.index)], axis=1)

    def _results(self, outs: list, index) -> pd.DataFrame:
        names = [part.split()[0] for part in self.fold.result.split(",")]
        return pd.DataFrame(outs, columns=names, index=index)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield pd.DataFrame(columns=[*self.columns, *self._results([], None).columns])

    def close(self) -> None:
        pass


class CellProcessor(FoldProcessor):
    """The same for many keys in one state, where a key of its own would have few rows: what a key costs in
    calls and frames, a cell costs once. ``fold_key`` names the key of a row. With ``closing`` the cell's timer is
    that of the key that ends first, so each key ends when it would on its own; the fold says when."""

    def _until(self, states: dict, last: int | None = None) -> int | None:
        return min((self.fold.until(state) for state in states.values()), default=None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stored = self.state.get()
        states = json.loads(stored[0]) if stored else {}
        pdf = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        fields = self.fold.fields
        args = list(zip(*[pdf[f] for f in fields])) if fields else [()] * len(pdf)
        outs = []
        for own, at, row in zip(pdf["fold_key"], pdf[self.order[0]], args):
            if own not in states:
                states[own] = self.fold.start()
            outs.append(self.fold.step(states[own], int(at), tuple(_none(v) for v in row)))
        until = self._until(states) if self.closing else None
        if self.closing:
            self.timer.move(stored[1] if stored else None, until)
        self.state.update((json.dumps(states), until))
        yield pd.concat([pdf[self.columns], self._results(outs, pdf.index)], axis=1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        stored = self.state.get()
        states = json.loads(stored[0]) if stored else {}
        states = {own: state for own, state in states.items() if self.fold.until(state) > passed}
        if states:
            until = self._until(states)
            self.timer.move(None, until)
            self.state.update((json.dumps(states), until))
        else:
            self.state.clear()
        yield pd.DataFrame(columns=[*self.columns, *self._results([], None).columns])


def stream_fold(
    df: DataFrame,
    fold,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str] = (),
    ttl_ms: int | None = None,
    late_ms: int | None = None,
    keep_ms: int | None = None,
    cell: Column | None = None,
) -> DataFrame:
    """Run a fold over a stream. With ``late_ms`` the state of keys ends by a watermark on ``time`` that
    trails it by so much; rows that are later than that are decided like any other. Keys with the same
    ``cell``, a number that follows from the key, share one state."""
    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    closing, columns, kind = late_ms is not None, df.columns, FoldProcessor
    if cell is not None:
        # as text a key is exact: a missing part is left out, and both zeros are one
        parts = [(F.col(k) + F.lit(0.0)) if t in ("double", "float") else F.col(k) for k, t in _types(df, keys)]
        named = F.to_json(F.struct(*(part.alias(str(i)) for i, part in enumerate(parts))))
        df, keys, kind = df.withColumns({"fold_cell": cell, "fold_key": named}), ["fold_cell"], CellProcessor
    if closing:
        df = on_event_time(df, time, late_ms)
    processor = kind(fold, time, ties, columns, ttl_ms, closing, keep_ms)
    mode = "EventTime" if closing else "None" if ttl_ms is None else "ProcessingTime"
    return df.groupBy(*keys).transformWithStateInPandas(
        processor, f"{base}, {fold.result}", outputMode="Append", timeMode=mode
    )


def _types(df: DataFrame, columns: Sequence[str]) -> list[tuple[str, str]]:
    kinds = dict(df.dtypes)
    return [(c, kinds[c]) for c in columns]


def stream_alerts(alerts: DataFrame, params: HealthParams) -> DataFrame:
    return stream_fold(
        named_alerts(alerts), AlertFold(params), ALERT_KEYS, "created_at_ms", ["ord"]
    )


def stream_health_emissions(assessed: DataFrame, params: HealthParams) -> DataFrame:
    rows = assessed if "muted" in assessed.columns else assessed.withColumn("muted", F.lit(False))
    return stream_fold(
        rows, HealthEmissionFold(params), ["instance"], "created_at_ms", ["sid"]
    )


def stream_admissions(
    requests: DataFrame,
    keys: Sequence[str],
    time: str,
    limit: int,
    window_sec: float = 60.0,
    ties: Sequence[str] = (),
    late_ms: int | None = None,
) -> DataFrame:
    return stream_fold(requests, AdmissionFold(limit, window_sec), keys, time, ties, late_ms=late_ms)


#: Two days: keys of events name their day.
EVENT_KEY_MS = 172_800_000


def stream_cooldown(
    events: DataFrame, ttl_ms: int | None = None, late_ms: int | None = None
) -> DataFrame:
    """Events kept by their cooldown. Keys name their day: a continuous query should pass ``late_ms``, so
    that the state of past days goes by event time, or a ``ttl_ms`` of two days."""
    decided = stream_fold(
        events, CooldownFold(), ["dedup_key"], "ts_ms", ["event_type"], ttl_ms, late_ms, EVENT_KEY_MS
    )
    return decided.where("kept").drop("kept")
