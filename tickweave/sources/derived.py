"""Ticks and other inputs derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock
from ..params import HealthParams, MicroParams, QualityParams
from ..schema import TICK_COLUMNS
from ..session import utc

# the event table is sparse, so thresholds are scaled to hours
SPARSE_QUALITY = QualityParams(
    gap_threshold_sec=3600.0,
    active_window_sec=6 * 3600,
    active_min_ticks=5,
    stall_warn_sec=5400.0,
    slice_ms=6 * 3_600_000,
)
HOUR_MS = 3_600_000
SPARSE_MICRO = MicroParams(
    bucket_ms=HOUR_MS,
    price_bin=5.0,
    tick_size=1.0,
    short_ms=24 * HOUR_MS,
    long_ms=48 * HOUR_MS,
    compress_ms=3 * HOUR_MS,
    release_ms=24 * HOUR_MS,
    min_history=10,
    open_auction=(0, 9 * 3600),
    open_confirm=(9 * 3600 + 1800, 12 * 3600),
    close_auction=(16 * 3600, 20 * 3600),
    open_top3_share=0.3,
    close_share=0.12,
    close_distance=0.05,
)
SPARSE_HEALTH = HealthParams(
    drift_warn_sec=120,
    trading_interval_sec=2 * 3600,
    offhours_interval_sec=5 * 3600,
    preopen_interval_sec=3600,
    warn_cadence_sec=6 * 3600,
    alert_cadence_sec=3 * 3600,
    alert_cooldown_sec=4 * 3600,
    escalation_steps=(0, 4 * 3600, 10 * 3600),
    stall_sec=2 * 3600,
    upstream_window_sec=1800,
    queue_threshold_rows=40,
)
NOW_MS = 1_706_659_200_000  # a fixed 'now' just after the last event day


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_ticks(spark: SparkSession, sf_dir: str, *, resent: bool = False) -> DataFrame:
    """TICKS plus ``ingest_ordinal`` from ``events``.

    ``resent`` adds a later copy of the rows of the first thirty users, as a poll would fetch them.
    """
    ev = table(spark, sf_dir, "events")
    ident = F.col("event_id")
    unknown = ident % 77 == 0
    volume = 1 + F.col("user_id") % 100
    ts = F.unix_millis(F.col("ts").cast("timestamp"))
    base = ev.select(
        F.lit("HK").alias("market"),
        F.concat(F.lit("HK."), "event_type").alias("symbol"),
        ts.alias("ts_ms"),
        F.when(~unknown, F.col("value")).alias("price"),
        volume.alias("volume"),
        F.when(~unknown, F.round(F.col("value") * volume, 2)).alias("turnover"),
        F.when(ident % 5 == 0, F.lit(None))
        .when(ident % 2 == 0, "BUY")
        .otherwise("SELL")
        .alias("direction"),
        F.when(ident % 7 != 0, ident).alias("seq"),
        F.lit("AUTO_MATCH").alias("tick_type"),
        F.element_at(
            F.array(F.lit("push"), F.lit("poll"), F.lit("backfill")), (ident % 3 + 1).cast("int")
        ).alias("push_type"),
        F.lit("feed").alias("provider"),
        clock.trading_day(ts).alias("trading_day"),
        (ts + ident % 5000).alias("recv_ts_ms"),
        (ts + ident % 5000).alias("inserted_at_ms"),
        (ident * 2).alias("ingest_ordinal"),
        "user_id",
    )
    if resent:
        again = base.where("user_id < 30").withColumns(
            {
                "push_type": F.lit("poll"),
                "recv_ts_ms": F.col("recv_ts_ms") + 7000,
                "inserted_at_ms": F.col("inserted_at_ms") + 7000,
                "ingest_ordinal": F.col("ingest_ordinal") + 1,
            }
        )
        base = base.unionByName(again)
    return base.select(*TICK_COLUMNS, "ingest_ordinal")


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TICKS from ``lineitem``: a symbol per supplier, spread over the trading hours of the day.

    Repeated (order, line, supplier) rows are real duplicates; the ordinal columns order them.
    """
    li = table(spark, sf_dir, "lineitem")
    midnight = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    offset = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 23_400_000
    ts = midnight + 5_400_000 + offset
    volume = F.col("l_quantity").cast("bigint")
    return li.select(
        F.lit("HK").alias("market"),
        F.concat(F.lit("HK."), F.lpad(F.col("l_suppkey").cast("string"), 5, "0")).alias("symbol"),
        ts.alias("ts_ms"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        volume.alias("volume"),
        F.col("l_extendedprice").alias("turnover"),
        F.when(F.col("l_returnflag") == "A", "BUY")
        .when(F.col("l_returnflag") == "R", "SELL")
        .alias("direction"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        F.lit("AUTO_MATCH").alias("tick_type"),
        F.lit("push").alias("push_type"),
        F.lit("feed").alias("provider"),
        clock.trading_day(ts).alias("trading_day"),
        ts.alias("recv_ts_ms"),
        ts.alias("inserted_at_ms"),
        "l_partkey",
        "l_discount",
        "l_tax",
        "l_linestatus",
    )


LINEITEM_ARRIVAL = (
    "recv_ts_ms", "l_partkey", "price", "volume", "turnover", "l_discount", "l_tax", "l_linestatus",
)


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loosely named feed records from ``events``: eight time notations, aliases, bad rows.

    User 77 sends an unreadable time, user 13 no code, user 14 uses the other code column, user 99
    stamps local time as UTC.
    """
    ev = table(spark, sf_dir, "events")
    ident, user = F.col("event_id"), F.col("user_id")
    code = F.concat(F.lit("HK."), "event_type")
    ts = F.unix_millis(F.col("ts").cast("timestamp"))
    local = F.from_utc_timestamp(F.timestamp_millis(ts), "Asia/Hong_Kong")
    show = lambda pattern: F.date_format(local, pattern)
    kind = ident % 8
    odd = (user == 77) | (user == 99)
    time = (
        F.when(user == 77, "no such time")
        .when(user == 99, (ts + 28_800_000).cast("string"))
        .when(kind == 0, show("yyyy-MM-dd HH:mm:ss.SSS"))
        .when(kind == 1, show("yyyy/MM/dd HH:mm:ss"))
        .when(kind == 2, show("HHmmss"))
        .when(kind == 3, show("yyyyMMddHHmmss"))
        .when(
            kind == 4,
            F.concat(
                F.date_format(F.timestamp_millis(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00")
            ),
        )
        .when(kind == 7, show("HH:mm:ss.SSS"))
        .otherwise("")
    )
    return ev.select(
        ident,
        (ts + ident % 5000).alias("recv_ts_ms"),
        F.when((user != 13) & (user != 14), code).otherwise("").alias("code"),
        F.when(user == 14, code).alias("symbol"),
        time.alias("time"),
        F.when((kind == 5) & ~odd, F.floor(ts / 1000).cast("string")).alias("timestamp"),
        F.when((kind == 6) & ~odd, ts.cast("string")).alias("ts"),
        F.when(kind == 2, show("yyyy-MM-dd")).alias("trading_day"),
        F.when(kind == 7, show("yyyy/MM/dd")).alias("date"),
        F.when(ident % 77 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("price"),
        F.when(ident % 50 == 1, "100.0")
        .otherwise((1 + user % 100).cast("string"))
        .alias("volume"),
        (F.col("value") * 2).alias("turnover"),
        F.lit("").alias("ticker_direction"),
        F.when(ident % 5 != 0, F.lit(" BUY ")).alias("direction"),
        F.when(ident % 3 == 0, F.lit(0)).otherwise(ident).cast("bigint").alias("sequence"),
        F.when(ident % 7 != 0, ident).alias("seq"),
        F.lit("AUTO_MATCH").alias("type"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service log lines told from ``events``: health, persist, watchdog, alert and plain lines."""
    ev = table(spark, sf_dir, "events")
    ident, user = F.col("event_id"), F.col("user_id")
    value = F.col("value").cast("decimal(12,2)").cast("string")
    line = (
        F.when(
            F.col("event_type") == "view",
            F.format_string(
                "INFO health sid=s%d queue=%d/500 drift_sec=%s persisted_per_min=%d",
                ident, user, value, user * 3,
            ),
        )
        .when(
            F.col("event_type") == "click",
            F.format_string("info persist_summary lag=%s write=%d", value, user),
        )
        .when(
            F.col("event_type") == "error",
            F.format_string(
                "ERROR send failed token = abc%d via 12345678%d:ABCDEFGHIJ_KLMNOPQRST-%d",
                ident, user, ident,
            ),
        )
        .when(
            F.col("event_type") == "purchase",
            F.format_string("WARNING alert_event code=PERSIST_STALL eid=e%d severity=WARN", ident),
        )
        .otherwise(F.format_string("debug idle tick %d", ident))
    )
    return ev.select(ident.alias("ord"), line.alias("line"))


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly snapshots of five instances, counted from ``events``."""
    ev = table(spark, sf_dir, "events")
    value = F.col("value")
    rows = ev.withColumns(
        {
            "ts_ms": F.unix_millis(F.col("ts").cast("timestamp")),
            "instance": F.concat(F.lit("node"), (F.col("user_id") % 5).cast("string")),
            "symbol": F.concat(F.lit("HK."), "event_type"),
        }
    ).withColumn(
        "created_at_ms",
        (F.floor(F.col("ts_ms") / HOUR_MS) * HOUR_MS + HOUR_MS).cast("bigint"),
    )
    over = lambda limit: F.count_if(value > limit)
    per_symbol = rows.groupBy("instance", "created_at_ms", "symbol").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("ts_ms").alias("last_ts"),
        F.max("event_id").alias("last_seq"),
        (F.sum("user_id") % 50 - 10).alias("lag"),
        F.max("value").alias("top"),
        over(60).alias("v60"),
        over(80).alias("v80"),
        over(100).alias("v100"),
        over(120).alias("v120"),
        over(150).alias("v150"),
    )
    age = (F.col("created_at_ms") - F.col("last_ts")) / 1000.0
    item = F.struct(
        "symbol",
        F.when(F.col("symbol") != "HK.signup", age).alias("last_tick_age_sec"),
        F.col("last_seq").alias("last_persisted_seq"),
        F.col("lag").alias("max_seq_lag"),
    )
    hour = (F.col("created_at_ms") - 1_704_067_200_000) / HOUR_MS
    return (
        per_symbol.groupBy("instance", "created_at_ms")
        .agg(
            F.sort_array(F.collect_list(item)).alias("symbols"),
            F.sum("n").alias("poll_fetched"),
            (F.max("top") - 100).alias("drift_sec"),
            (F.sum("v150") * 40).alias("queue_size"),
            (F.sum("v60") * 10).alias("persisted_rows_per_min"),
            F.sum("v80").alias("push_rows_per_min"),
            F.sum("v100").alias("poll_accepted"),
            F.sum("v120").alias("queue_out"),
            F.sum(F.when(F.col("symbol") == "HK.error", F.col("n")).otherwise(0)).alias(
                "dropped_duplicate"
            ),
            F.sum(F.when(F.col("symbol") == "HK.view", F.col("n")).otherwise(0)).alias("views"),
        )
        .withColumns(
            {
                "sid": F.concat_ws("-", "instance", F.col("created_at_ms").cast("string")),
                "trading_day": clock.trading_day("created_at_ms"),
                "queue_maxsize": F.lit(100).cast("bigint"),
                "db_rows": F.floor(hour).cast("bigint") * 100 + F.col("poll_fetched"),
            }
        )
    )


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline counters of the same instances."""
    at = F.col("created_at_ms")
    return health(spark, sf_dir).select(
        "instance",
        at.alias("minute_ms"),
        F.lit(1_704_067_200_000).cast("bigint").alias("started_at_ms"),
        "queue_size",
        F.col("persisted_rows_per_min").alias("persisted_rows"),
        F.col("poll_accepted").alias("queue_in"),
        "queue_out",
        F.col("push_rows_per_min").alias("push_rows"),
        F.col("poll_accepted").alias("poll_enqueued"),
        "poll_fetched",
        F.col("views").alias("poll_seq_advanced"),
        F.when(F.col("push_rows_per_min") > 0, at - 30_000).alias("upstream_at_ms"),
        F.when(F.col("persisted_rows_per_min") > 0, at - 5_000).alias("commit_at_ms"),
        (F.col("dropped_duplicate") < 3).alias("worker_alive"),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts and recoveries told from ``events``: twenty fingerprints, severity by value."""
    ev = table(spark, sf_dir, "events")
    ts = F.unix_millis(F.col("ts").cast("timestamp"))
    value = F.col("value")
    kind = F.when(value.between(20, 25), "resolve").otherwise("alert")
    severity = (
        F.when(kind == "resolve", "OK")
        .when(value > 100, "ALERT")
        .when(value > 30, "WARN")
        .otherwise("OK")
    )
    return ev.select(
        ts.alias("created_at_ms"),
        F.col("event_id").alias("ord"),
        kind.alias("kind"),
        F.col("event_type").alias("code"),
        F.concat_ws(":", "event_type", (F.col("user_id") % 4).cast("string")).alias("key"),
        F.lit("").alias("fingerprint"),
        F.concat(F.lit("node"), (F.col("user_id") % 5).cast("string")).alias("instance"),
        clock.trading_day(ts).alias("trading_day"),
        severity.alias("severity"),
        F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("s"), "event_id")).alias("sid"),
        F.when(kind == "alert", F.concat(F.lit("e"), "event_id")).alias("eid"),
    )
