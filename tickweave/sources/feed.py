"""Raw feed records to typed ticks (batch or stream), in one select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clock, text
from ..params import DEFAULT_TZ
from ..schema import RAW, TICK_COLUMNS

# fixed values: accepted column names per field, first set one wins
ALIASES = {
    "code": ("code", "symbol"),
    "time": ("time", "timestamp", "ts"),
    "trading_day": ("trading_day", "date"),
    "direction": ("ticker_direction", "direction"),
    "seq": ("sequence", "seq"),
    "tick_type": ("type", "tick_type"),
}


def read_feed(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType = RAW):
    return spark.read.schema(schema).format(fmt).load(path)


def stream_feed(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    schema: T.StructType = RAW,
    files_per_trigger: int = 100,
) -> DataFrame:
    """A landing folder as a stream; the file limit bounds a micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .format(fmt)
        .load(path)
    )


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def _text_choice(df: DataFrame, field: str, default: str | None = None) -> Column:
    names = [n for n in ALIASES[field] if n in df.columns]
    columns = [F.col(n).cast("string") for n in names] + [F.lit(default).cast("string")]
    return text.first_set(*columns)


def _time_choice(df: DataFrame) -> tuple[Column, Column]:
    """The first set time column as text, and whether it came from a number."""
    names = [n for n in ALIASES["time"] if n in df.columns]
    shown, number = None, None
    for name in names:
        numeric = _is_number(df, name)
        filled = F.col(name) != (F.lit(0) if numeric else F.lit(""))
        if name == names[-1]:
            filled = F.lit(True)
        value = (F.col(name).try_cast("bigint") if numeric else F.col(name)).cast("string")
        shown = F.when(filled, value) if shown is None else shown.when(filled, value)
        flag = F.lit(numeric)
        number = F.when(filled, flag) if number is None else number.when(filled, flag)
    return shown, number


def _seq_choice(df: DataFrame) -> Column:
    names = [n for n in ALIASES["seq"] if n in df.columns]
    if not names:
        return F.lit(None).cast("bigint")
    if all(_is_number(df, n) for n in names):
        return text.to_long(text.first_set(*[F.col(n) for n in names], numeric=True))
    return text.to_long(text.first_set(*[F.col(n).cast("string") for n in names]))


def normalize(
    raw: DataFrame,
    *,
    recv_ts_ms: Column,
    push_type: Column | str,
    provider: str = "feed",
    default_symbol: str | None = None,
    trading_day: str | None = None,
    tz: str = DEFAULT_TZ,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every raw row as TICKS columns plus ``reject_reason`` (NULL for a good row).

    A row that cannot be read is marked, never dropped here, and does not spoil its batch.
    """
    day = clock.normalize_day(_text_choice(raw, "trading_day", trading_day))
    origin = F.lit(push_type) if isinstance(push_type, str) else push_type
    get = lambda n, t: F.col(n) if n in raw.columns else F.lit(None).cast(t)
    time, is_number = _time_choice(raw)
    chosen = raw.select(
        *[F.col(k) for k in keep],
        _text_choice(raw, "code", default_symbol).alias("symbol"),
        time.alias("_time"),
        is_number.alias("_time_number"),
        day.alias("_given_day"),
        text.to_float(get("price", "double")).alias("price"),
        text.to_long(get("volume", "string")).alias("volume"),
        text.to_float(get("turnover", "double")).alias("turnover"),
        text.clean_text(_text_choice(raw, "direction")).alias("direction"),
        _seq_choice(raw).alias("seq"),
        text.clean_text(_text_choice(raw, "tick_type")).alias("tick_type"),
        origin.alias("push_type"),
        F.lit(provider).alias("provider"),
        recv_ts_ms.cast("bigint").alias("_recv"),
    )
    timed = clock.with_time(
        chosen,
        "ts_ms",
        F.col("_time"),
        F.col("_given_day"),
        F.col("_recv"),
        is_number=F.col("_time_number"),
        tz=tz,
    )
    reason = F.when(F.coalesce(F.col("symbol"), F.lit("")) == "", "missing_code").when(
        F.col("ts_ms").isNull(), "bad_time"
    )
    return timed.withColumns(
        {
            "market": text.market_of("symbol"),
            "trading_day": F.coalesce("_given_day", clock.trading_day("ts_ms", tz)),
            "recv_ts_ms": F.col("_recv"),
            "inserted_at_ms": F.col("_recv"),
            "reject_reason": reason,
        }
    ).select(*[k for k in keep if k not in TICK_COLUMNS], *TICK_COLUMNS, "reject_reason")


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col("reject_reason").isNotNull())


def split_other_symbols(ticks: DataFrame, symbol: str) -> tuple[DataFrame, DataFrame]:
    """A poll answers for one symbol: its rows, and a one-row count of the rows of others."""
    mine = F.col("symbol") == symbol
    return ticks.where(mine), ticks.agg(F.count_if(~mine).alias("dropped_filter"))


def with_ingest_ordinal(ticks: DataFrame, name: str = "ingest_ordinal") -> DataFrame:
    """A number that grows within each input file part; stands in for a row id."""
    return ticks.withColumn(name, F.monotonically_increasing_id())


def union_origins(*parts: DataFrame) -> DataFrame:
    """Push, poll and backfill ticks as one table."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
