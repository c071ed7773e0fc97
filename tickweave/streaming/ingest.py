"""Streaming load of feed records into the day tables.

Micro-batches are bounded by the source's file limit and paced by the trigger. Each batch is loaded
insert-or-ignore and marked by its epoch, so a batch replayed after a failure adds nothing; the tick and
gap tables need no common transaction for the same reason. A load is named by its checkpoint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..operators import dedupe
from ..operators.folds import RecentKeysFold, RepeatFold
from ..params import QualityParams
from ..session import ROCKSDB_PROVIDER, utc
from ..sources.feed import with_ingest_ordinal
from ..sources.store import LoadResult, TickStore
from .decision_stream import stream_fold
from .gap_stream import stream_gaps

#: Ticks of a symbol whose times lie in the same ten minutes share the state of their repeats.
REPEAT_CELL_MS = 600_000

Observer = Callable[[int, LoadResult], None]


def streaming_session(spark: SparkSession) -> SparkSession:
    """Settings the stateful operators need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return utc(spark)


def paced(writer: DataStreamWriter, wait: str | None) -> DataStreamWriter:
    """Trigger every ``wait`` (such as ``1 second``), or once over all available data."""
    return writer.trigger(availableNow=True) if wait is None else writer.trigger(processingTime=wait)


def load_name(checkpoint: str) -> str:
    """The name that the batches of a checkpoint are marked by."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def load_ticks(
    ticks: DataFrame,
    store: TickStore,
    checkpoint: str,
    *,
    wait: str | None = "1 second",
    poll_baseline_days: int | None = None,
    observer: Observer | None = None,
) -> StreamingQuery:
    """Load a stream of ticks. Without an ``ingest_ordinal`` rows are numbered in each batch.

    With ``poll_baseline_days`` polled rows at or below the highest stored seq of those newest days
    are dropped first. ``observer`` hears the counts of each committed batch.
    """

    load_id = load_name(checkpoint)

    def load(batch: DataFrame, epoch: int) -> None:
        if "ingest_ordinal" not in batch.columns:
            batch = with_ingest_ordinal(batch)
        batch.persist()
        try:
            rows = batch
            if poll_baseline_days is not None:
                rows = drop_old_polled(batch, store, poll_baseline_days)
            result = store.append_ticks(rows, load=load_id, epoch=epoch)
            if epoch % 100 == 99:
                store.drop_old_versions()
        finally:
            batch.unpersist()
        if observer is not None:
            observer(epoch, result)

    writer = ticks.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return paced(writer, wait).start()


def drop_old_polled(batch: DataFrame, store: TickStore, days: int) -> DataFrame:
    """Push and backfill rows as they are; polled rows only above what is stored already."""
    baseline = store.persisted_seqs(days)
    polled = F.col("push_type") == "poll"
    flagged = dedupe.flag_polled(batch.where(polled), baseline)
    kept = flagged.where("outcome = 'kept'").drop("outcome")
    return batch.where(~F.coalesce(polled, F.lit(False))).unionByName(kept)


def load_gaps(
    ticks: DataFrame,
    store: TickStore,
    params: QualityParams,
    checkpoint: str,
    *,
    wait: str | None = "1 second",
) -> StreamingQuery:
    def load(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            store.append_gaps(batch)
        finally:
            batch.unpersist()

    writer = stream_gaps(ticks, params).writeStream.foreachBatch(load)
    return paced(writer.option("checkpointLocation", checkpoint), wait).start()


def drop_recent_repeats(
    ticks: DataFrame, horizon_ms: int = 600_000, ttl_ms: int | None = None, late_ms: int | None = None
) -> DataFrame:
    """Drop seq-less ticks seen within ``horizon_ms`` of receive time; ticks with a seq pass. Missing
    parts of a key equal each other.

    A row that arrives out of order is compared like any other and never lost. A continuous query
    should pass ``late_ms``, how far rows may trail the newest receive time: a key's state goes once no row
    within the horizon can come.

    A key names its tick's time, so nearly all keys have one row; those of a symbol's ten minutes share one
    state. With ``ttl_ms``, which is per state, each key has its own.
    """
    seqless = F.col("seq").isNull()
    keys = ["symbol", "ts_ms", "price", "volume", "turnover"]
    slot = F.coalesce(F.floor(F.col("ts_ms") / REPEAT_CELL_MS), F.xxhash64(*keys))
    decided = stream_fold(
        ticks.where(seqless), RepeatFold(horizon_ms), keys, "recv_ts_ms", ttl_ms=ttl_ms, late_ms=late_ms,
        cell=F.xxhash64("symbol", slot) if ttl_ms is None else None,
    )
    return ticks.where(~seqless).unionByName(decided.where("kept").drop("kept"))


def drop_remembered(ticks: DataFrame, limit: int = 500) -> DataFrame:
    """Drop polled seq-less ticks whose key is among the newest ``limit`` of their symbol, in order of
    receive time and ordinal within a micro-batch; all others pass. State is ``limit`` keys per symbol.
    Missing parts of a key equal each other."""
    seqless = F.col("seq").isNull()
    decided = stream_fold(
        ticks.where(seqless), RecentKeysFold(limit), ["symbol"], "recv_ts_ms", ["ingest_ordinal"]
    )
    return ticks.where(~seqless).unionByName(decided.where("kept").drop("kept"))


class LoadProgress(StreamingQueryListener):
    """Keeps the newest progress of each query: batch, input rows and rows per second."""

    def __init__(self) -> None:
        self.latest: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        self.latest[str(event.id)] = {"batch": None, "rows": 0, "per_sec": 0.0}

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.latest[str(p.id)] = {
            "batch": p.batchId,
            "rows": p.numInputRows,
            "per_sec": p.processedRowsPerSecond,
        }

    def onQueryTerminated(self, event) -> None:
        pass
