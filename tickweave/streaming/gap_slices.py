"""Live gap detection without state per symbol in one task: each micro-batch is the batch form over slices.

What a batch needs of earlier ones is a table: the distinct tick times of each symbol within the activity
window of its last time. A micro-batch joins it, drops ticks at or before their symbol's last time, and
detects gaps by ``operators.gaps``, which cuts the time axis into slices and hands the window's points from
each slice to the next; so one busy symbol is spread over tasks, in the JVM. The table is written anew per
epoch: a batch replayed after a failure reads the table before it, finds the same gaps, which are stored
once, and writes the same table again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import gaps
from ..params import QualityParams
from ..schema import GAP_COLUMNS
from ..session import delete_folder, listed, touch
from ..sources.store import TickStore
from .ingest import load_name, paced

POINTS = "symbol string, trading_day string, ts_ms bigint"


def _tail(store: TickStore, folder: str, epoch: int) -> DataFrame:
    """The points left by the newest epoch before this one."""
    before = [int(name) for name in listed(store.spark, f"{folder}/done") if int(name) < epoch]
    if not before:
        return store.spark.createDataFrame([], POINTS)
    return store.spark.read.schema(POINTS).parquet(f"{folder}/points/{max(before)}")


def batch_gaps(
    batch: DataFrame, tail: DataFrame, params: QualityParams
) -> tuple[DataFrame, DataFrame]:
    """GAPS rows of a micro-batch behind the points of earlier ones, and the points that it leaves. A gap is
    detected at the largest receive time of its symbol's rows in the batch."""
    rows = batch.where(F.coalesce("symbol", F.lit("")) != "")
    last = tail.groupBy("symbol").agg(F.max("ts_ms").alias("_last"))
    points = rows.select("symbol", "trading_day", "ts_ms").distinct().join(last, "symbol", "left")
    fresh = points.where(F.col("_last").isNull() | (F.col("ts_ms") > F.col("_last"))).drop("_last")
    known = tail.unionByName(fresh)
    received = rows.groupBy("symbol").agg(F.max(F.coalesce("recv_ts_ms", F.lit(0))).alias("_received"))
    found = (
        gaps.hard_gaps(known, params, 0)
        .join(last, "symbol", "left")
        .where(F.col("_last").isNull() | (F.col("gap_end_ts_ms") > F.col("_last")))
        .join(received, "symbol")
        .withColumn("detected_at_ms", F.col("_received"))
        .select(*GAP_COLUMNS)
    )
    newest = known.groupBy("symbol").agg(F.max("ts_ms").alias("_newest"))
    left = known.join(newest, "symbol").where(F.col("ts_ms") >= F.col("_newest") - params.window_ms)
    return found, left.select("symbol", "trading_day", "ts_ms")


def load_gaps_by_slices(
    ticks: DataFrame,
    store: TickStore,
    params: QualityParams,
    checkpoint: str,
    *,
    wait: str | None = "1 second",
) -> StreamingQuery:
    """Detect gaps in a stream of ticks and store them. The points table lies with the store, by the name of
    the checkpoint."""
    folder = f"{store.root}/gap_points/{load_name(checkpoint)}"

    def load(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            found, left = batch_gaps(batch, _tail(store, folder, epoch), params)
            left.write.mode("overwrite").parquet(f"{folder}/points/{epoch}")
            store.append_gaps(found)
        finally:
            batch.unpersist()
        touch(store.spark, f"{folder}/done/{epoch}")
        for name in listed(store.spark, f"{folder}/done"):
            if int(name) < epoch - 2:
                delete_folder(store.spark, f"{folder}/points/{name}")
                delete_folder(store.spark, f"{folder}/done/{name}")

    writer = ticks.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return paced(writer, wait).start()
