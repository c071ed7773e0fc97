"""Fixed schemas. Tables are never inferred; only the raw feed edge is loose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _fields(text: str) -> T.StructType:
    """``"name type, name type"`` without needing a session."""
    pairs = (item.split() for item in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW = _fields(
    "code string, symbol string, time string, timestamp string, ts string, trading_day string, "
    "date string, price double, volume string, turnover double, ticker_direction string, "
    "direction string, sequence bigint, seq bigint, type string, tick_type string"
)

TICKS = _fields(
    "market string, symbol string, ts_ms bigint, price double, volume bigint, turnover double, "
    "direction string, seq bigint, tick_type string, push_type string, provider string, "
    "trading_day string, recv_ts_ms bigint, inserted_at_ms bigint"
)
TICK_COLUMNS = TICKS.fieldNames()
TICK_REQUIRED = ("market", "symbol", "ts_ms", "trading_day", "recv_ts_ms", "inserted_at_ms")

GAPS = _fields(
    "trading_day string, symbol string, gap_start_ts_ms bigint, gap_end_ts_ms bigint, "
    "gap_sec double, detected_at_ms bigint, reason string, meta_json string"
)
GAP_COLUMNS = GAPS.fieldNames()
GAP_KEY = ("symbol", "gap_start_ts_ms", "gap_end_ts_ms")

DAILY_QUALITY = _fields(
    "trading_day string, created_at_ms bigint, host string, symbols_json string, summary_json string"
)

MANIFEST = _fields(
    "trading_day string, created_at_ms bigint, archive_path string, compression string, "
    "ticks_count bigint, max_ts_ms bigint, content_hash string, verify_ok boolean, "
    "total_rows bigint, start_ts_ms bigint, end_ts_ms bigint, hard_gaps_total bigint, "
    "hard_gaps_total_sec double, quality_grade string, archive_bytes bigint, archive_sha256 string, "
    "host string, source_path string"
)

CHECKSUMS = _fields("file string, bytes bigint, sha256 string, trading_day string")

HEALTH = _fields(
    "instance string, sid string, created_at_ms bigint, trading_day string, db_rows bigint, "
    "drift_sec double, queue_size bigint, queue_maxsize bigint, push_rows_per_min bigint, "
    "poll_fetched bigint, poll_accepted bigint, persisted_rows_per_min bigint, "
    "dropped_duplicate bigint"
).add(
    "symbols",
    T.ArrayType(
        _fields(
            "symbol string, last_tick_age_sec double, last_persisted_seq bigint, max_seq_lag bigint"
        )
    ),
)

ALERTS = _fields(
    "created_at_ms bigint, ord bigint, kind string, code string, key string, fingerprint string, "
    "trading_day string, severity string, sid string, eid string, instance string"
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order; absent ones become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
