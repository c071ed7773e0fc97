"""File exports: gap list, vendor CSV per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clock, text
from ..params import DEFAULT_TZ
from ..schema import GAP_COLUMNS


def gaps_listing(gaps: DataFrame, day: str | None = None) -> DataFrame:
    rows = gaps if day is None else gaps.where(F.col("trading_day") == day)
    return rows.select(*GAP_COLUMNS).orderBy("trading_day", "symbol", "gap_start_ts_ms")


def export_gaps(gaps: DataFrame, path: str, day: str | None = None) -> None:
    gaps_listing(gaps, day).write.mode("overwrite").csv(path, header=True)


def vendor_rows(ticks: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """The nine vendor columns; ``name`` is always empty and times are local, to the second."""
    return ticks.select(*_vendor_exprs(tz))


def export_vendor_csv(
    ticks: DataFrame, path: str, *, ordinal: str = "ingest_ordinal", tz: str = DEFAULT_TZ
) -> None:
    """All days and symbols in one job, a folder per day and symbol.

    Rows are ranged by (day, symbol, time), so a busy symbol is cut over several tasks; its files
    read in name order give the total order ``ts_ms, seq (missing as -1), ordinal``.
    """
    # folder columns lead the order and are never NULL: otherwise the writer would sort by them again
    # and lose the order of the rows
    order = ["trading_day", "file", "symbol", "ts_ms", "_seq_order", ordinal]
    ranged = (
        ticks.where(F.coalesce("symbol", F.lit("")) != "")
        .withColumns(
            {
                "trading_day": F.coalesce("trading_day", F.lit("")),
                "file": F.coalesce(text.file_stem("symbol"), F.lit("UNKNOWN")),
                "_seq_order": F.coalesce("seq", F.lit(-1)),
            }
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    (
        ranged.select("trading_day", "file", *_vendor_exprs(tz))
        .write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .partitionBy("trading_day", "file")
        .csv(path)
    )


def _vendor_exprs(tz: str) -> list:
    return [
        F.col("symbol").alias("code"),
        F.lit("").alias("name"),
        clock.local_text("ts_ms", tz).alias("time"),
        F.col("price"),
        F.col("volume"),
        F.col("turnover"),
        F.col("direction").alias("ticker_direction"),
        F.col("seq").alias("sequence"),
        F.col("tick_type").alias("type"),
    ]
