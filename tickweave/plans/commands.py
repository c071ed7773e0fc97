"""The command surface as functions returning DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import archive as archive_ops
from ..operators import events, export, features, levels, quality, stats
from ..params import DEFAULT_TZ, MicroParams, QualityParams
from ..sources import logs as log_source
from ..sources.store import TickStore, footprint, write_days


def status(
    store: TickStore, now_ms: int, days: Sequence[str] | None = None, symbols: Sequence[str] = ()
) -> DataFrame:
    return quality.status(store.ticks(days), store.gaps(days), now_ms, symbols)


def service_status(
    store: TickStore, now_ms: int, log_path: str, days: Sequence[str] | None = None,
    since: str | None = None,
) -> DataFrame:
    """``status`` with the size of each day on disk and the newest health and alert lines."""
    rows = status(store, now_ms, days)
    sizes = footprint(store.spark, store.ticks_path, days)
    lines = last_log_lines(store.spark, log_path, since=since)
    newest = {c: lines.select(c).scalar() for c in ("last_health", "last_alert")}
    return rows.join(sizes, "trading_day", "left").withColumns(newest)


def validate(
    store: TickStore, days: Sequence[str], now_ms: int, *, strict: bool = False
) -> DataFrame:
    return quality.validate(
        quality.requested_days(store.spark, days),
        store.ticks(days),
        store.gaps(days),
        now_ms,
        strict=strict,
        ticks_table=store.has_ticks(),
        gaps_table=store.has_gaps(),
    )


def report(
    store: TickStore, days: Sequence[str], params: QualityParams, now_ms: int, top_n: int = 20
) -> DataFrame:
    return quality.daily_report(
        store.ticks(days),
        store.gaps(days),
        params,
        now_ms,
        days=quality.requested_days(store.spark, days),
        top_n=top_n,
        ticks_table=store.has_ticks(),
        gaps_table=store.has_gaps(),
    )


def export_report(
    store: TickStore, days: Sequence[str], params: QualityParams, now_ms: int, path: str
) -> None:
    quality.write_reports(report(store, days, params, now_ms), path)


def export_gaps(store: TickStore, path: str, day: str | None = None) -> None:
    export.export_gaps(store.gaps(None if day is None else [day]), path, day)


def archive(
    store: TickStore,
    root: str,
    params: QualityParams,
    now_ms: int,
    days: Sequence[str] | None = None,
    keep_days: int = 14,
) -> tuple[DataFrame, DataFrame]:
    """The manifest, and the days that may be retired; nothing is deleted here."""
    manifest = archive_ops.archive_days(store, root, params, now_ms, days)
    return manifest, archive_ops.expired_days(store.ticks(), manifest, keep_days, root, store.day_prints)


def logs(
    spark, path: str, *, ops: bool = False, since: str | None = None, until: str | None = None
) -> DataFrame:
    lines = log_source.between(log_source.read_logs(spark, path), since, until)
    return log_source.service_log(lines, ops=ops)


def last_log_lines(
    spark, path: str, *, since: str | None = None, until: str | None = None
) -> DataFrame:
    """The newest lines that status and diagnosis show."""
    return log_source.last_lines(log_source.between(log_source.read_logs(spark, path), since, until))


def db_stats(store: TickStore, days: Sequence[str] | None = None) -> DataFrame:
    rows = store.ticks(days).groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("rows"), F.max("ts_ms").alias("max_ts_ms")
    )
    return rows.join(footprint(store.spark, store.ticks_path), "trading_day", "left")


def db_symbols(ticks: DataFrame, now_ms: int, tz: str = DEFAULT_TZ) -> DataFrame:
    rows = ticks.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.max("ts_ms").alias("latest_ts_ms")
    )
    shown = stats.with_local_times(rows, tz, latest_local="latest_ts_ms")
    return shown.withColumn("last_tick_age_sec", stats.age_sec("latest_ts_ms", now_ms)).drop(
        "latest_ts_ms"
    )


def db_symbol(
    ticks: DataFrame, symbol: str, last: int = 20, tz: str = DEFAULT_TZ, *, with_time: bool = False
) -> DataFrame:
    """The newest ``last`` ticks of a symbol; ``with_time`` adds their plain time."""
    rows = stats.latest_ticks(ticks, max(1, int(last)), symbol)
    return stats.with_local_times(rows, tz, local_time="ts_ms").select(
        "symbol", "local_time", *(["ts_ms"] if with_time else []), "price", "volume", "turnover", "seq"
    )


def db_top_symbols(
    ticks: DataFrame,
    minutes: int = 15,
    metric: str = "rows",
    limit: int = 10,
    day: str | None = None,
) -> DataFrame:
    """The ranking; the command takes 1 to 240 minutes and 1 to 50 symbols."""
    return stats.top_symbols(
        ticks, max(1, min(240, int(minutes))), metric, max(1, min(50, int(limit))), day
    )


def micro_table(store: TickStore, name: str) -> DataFrame:
    """``features_1m`` (minute features with day levels and gates), ``features_base`` (the minute sums
    alone), ``levels_daily`` or ``events``."""
    path = f"{store.root}/{name}"
    found = store.spark.read.parquet(path).schema
    fixed = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "trading_day" else f.dataType)
            for f in found.fields
        ]
    )
    return store.spark.read.schema(fixed).parquet(path)


def build_micro_tables(
    store: TickStore,
    params: MicroParams,
    created_at_ms: int,
    days: Sequence[str] | None = None,
) -> None:
    """Build ``levels_daily``, ``features_1m`` and ``events`` for ``days`` (all by default), replacing
    those days only; a build by days gives what a build of all days gives.

    Each step reads the tables before it, so ticks are scanned for the profile and for the minute sums
    (``features_base``) and not again, and a failed run restarts from tables. What a day needs of
    earlier ones follows from the parameters: the levels of the newest earlier day of each symbol, and
    the minutes that trailing percentiles look back on.
    """
    ticks = store.ticks(days)
    wanted = F.lit(True) if days is None else F.col("trading_day").isin(list(days))
    profile = levels.day_profile(ticks, params)
    write_days(
        levels.day_levels(profile, params),
        f"{store.root}/levels_daily",
        sort=("symbol",),
        mode="overwrite",
    )
    write_days(
        features.minute_features(ticks, params),
        f"{store.root}/features_base",
        sort=("symbol", "ts_min_ms"),
        mode="overwrite",
    )
    base = micro_table(store, "features_base")
    day_rows = micro_table(store, "levels_daily")
    if days is not None:
        span = base.where(wanted).agg(F.min("ts_min_ms"), F.max("ts_min_ms")).first()
        halo_ms = max(params.long_ms, params.short_ms) + params.compress_ms
        if span[0] is not None:
            base = base.where(F.col("ts_min_ms").between(span[0] - halo_ms, span[1]))
        day_rows = day_rows.where(F.col("trading_day") <= max(days, default=""))
    gated = features.with_gates(features.with_levels(base, day_rows, params), params)
    write_days(
        gated.where(wanted),
        f"{store.root}/features_1m",
        sort=("symbol", "ts_min_ms"),
        mode="overwrite",
    )
    found = events.gated_events(
        micro_table(store, "features_1m").where(wanted), day_rows.where(wanted), params, created_at_ms
    )
    kept = events.apply_cooldown(events.distinct_events(found))
    write_days(kept, f"{store.root}/events", sort=("symbol", "ts_ms"), mode="overwrite")
