"""Event time for stateful operators: a watermark that closes and removes state.

A watermark trails the largest event time of a query by ``late_ms``. Operators hold a timer per key; when the
watermark has passed it, the key's state is removed, so a continuous query holds the open days only. Rows of
a key that was closed before are late: they come out as rows of their own and are never lost. The event-time
column itself does not reach the operator, so that Spark drops no row by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle


def on_event_time(rows: DataFrame, time: str, late_ms: int) -> DataFrame:
    """The same rows, followed by a watermark on the milliseconds in ``time``."""
    marked = rows.withColumn("_event_time", F.timestamp_millis(F.col(time)))
    return marked.withWatermark("_event_time", f"{int(late_ms)} milliseconds").select(*rows.columns)


def day_end(ts_ms: np.ndarray, tz: str) -> np.ndarray:
    """The first millisecond of the local day after each time."""
    local = pd.to_datetime(np.asarray(ts_ms, dtype=np.int64), unit="ms", utc=True).tz_convert(tz)
    following = (local.tz_localize(None).normalize() + pd.Timedelta(days=1)).tz_localize(tz)
    return following.tz_convert("UTC").tz_localize(None).as_unit("ms").asi8


def day_end_of(ts_ms: Column, tz: str) -> Column:
    """The same as an expression."""
    local = F.from_utc_timestamp(F.timestamp_millis(ts_ms), tz)
    return F.unix_millis(F.to_utc_timestamp(F.date_trunc("day", local) + F.expr("INTERVAL 1 DAY"), tz))


@dataclass
class Closing:
    """The one timer of a key."""

    handle: StatefulProcessorHandle

    def move(self, before: int | None, to: int | None) -> None:
        """Replace the key's timer."""
        if before == to:
            return
        if before is not None:
            self.handle.deleteTimer(before)
        if to is not None:
            self.handle.registerTimer(to)
