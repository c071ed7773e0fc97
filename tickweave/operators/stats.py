"""Per-day and per-symbol statistics, rankings, percentiles and top-k reads.

Everything starts from partial aggregates, so a dominant symbol shrinks on the map side. Whether one
side of a join is broadcast is left to the planner's own size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock
from ..params import DEFAULT_TZ

def symbol_stats(ticks: DataFrame) -> DataFrame:
    """Rows and time span per day and symbol."""
    return ticks.groupBy("trading_day", "symbol").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("ts_ms").alias("min_ts_ms"),
        F.max("ts_ms").alias("latest_ts_ms"),
    )


def day_stats(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("ts_ms").alias("start_ts_ms"),
        F.max("ts_ms").alias("end_ts_ms"),
    )


def day_stats_from_symbols(per_symbol: DataFrame) -> DataFrame:
    """Day statistics out of ``symbol_stats`` rows, without a second pass over the ticks."""
    return per_symbol.groupBy("trading_day").agg(
        F.sum("rows").alias("total_rows"),
        F.min("min_ts_ms").alias("start_ts_ms"),
        F.max("latest_ts_ms").alias("end_ts_ms"),
    )


def age_sec(ts_ms: Column | str, now_ms: int) -> Column:
    ts = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    return F.round(F.greatest(F.lit(0.0), (F.lit(now_ms) - ts) / 1000.0), 3)


def coverage(stats: DataFrame, now_ms: int) -> DataFrame:
    span = F.round((F.col("end_ts_ms") - F.col("start_ts_ms")) / 1000.0, 3)
    return stats.withColumns(
        {
            "duration_sec": F.coalesce(span, F.lit(0.0)),
            "last_tick_age_sec": age_sec("end_ts_ms", now_ms),
        }
    )


def drift(stats: DataFrame, now_ms: int, warn_sec: float = 120.0) -> DataFrame:
    sec = (F.lit(now_ms) - F.col("end_ts_ms")) / 1000.0
    return stats.withColumn("drift_sec", sec).withColumn(
        "drift_warn", F.abs(F.col("drift_sec")) > warn_sec
    )


def top_rows(per_symbol: DataFrame, n: int = 20) -> DataFrame:
    """Busiest symbols per day, ties by symbol."""
    order = Window.partitionBy("trading_day").orderBy(F.col("rows").desc(), "symbol")
    return per_symbol.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def status_symbols(
    per_symbol: DataFrame,
    symbols: Sequence[str] = (),
    n: int = 20,
    *,
    pre_filter: bool = False,
) -> DataFrame:
    """Top symbols with a name filter after the limit; ``pre_filter`` limits the wanted ones."""
    wanted = F.col("symbol").isin(list(symbols)) if symbols else F.lit(True)
    if pre_filter:
        return top_rows(per_symbol.where(wanted), n)
    return top_rows(per_symbol, n).where(wanted)


def recent_days(ticks: DataFrame, limit: int = 3) -> DataFrame:
    """Newest trading days by name; names that are no eight digits are skipped."""
    return (
        ticks.select("trading_day")
        .distinct()
        .where(F.col("trading_day").rlike(r"^\d{8}$"))
        .orderBy(F.col("trading_day").desc())
        .limit(max(0, int(limit)))
    )


def usable_days(days: Sequence[str]) -> list[str]:
    """Given day names, trimmed, without malformed and repeated ones, in the given order."""
    cleaned = (str(d).strip() for d in days)
    return list(dict.fromkeys(d for d in cleaned if len(d) == 8 and d.isdigit()))


def recent_max_seq(
    ticks: DataFrame,
    symbols: Sequence[str] | None,
    days: Sequence[str] | None = None,
    recent: int = 3,
) -> DataFrame:
    """Highest seq per symbol over the given days, or over the newest ``recent`` ones."""
    from .dedupe import max_seq_by_symbol

    if days:
        rows = ticks.where(F.col("trading_day").isin(usable_days(days)))
    else:
        rows = ticks.join(recent_days(ticks, recent), "trading_day")
    return max_seq_by_symbol(rows, symbols)


def trailing_window(ticks: DataFrame, minutes: int, day: str | None = None) -> DataFrame:
    """Ticks of the last ``minutes`` before the data's own end, per day.

    For one day the end is a scalar subquery, for all days a join of one row per day.
    """
    span = int(minutes) * 60_000
    if day is not None:
        rows = ticks.where(F.col("trading_day") == day)
        end = rows.agg(F.max("ts_ms") - span).scalar()
        return rows.where(F.col("ts_ms") >= end)
    ends = ticks.groupBy("trading_day").agg((F.max("ts_ms") - span).alias("_cutoff"))
    return ticks.join(ends, "trading_day").where("ts_ms >= _cutoff").drop("_cutoff")


TOP_METRICS = ("rows", "turnover", "volume")


def top_symbols(
    ticks: DataFrame,
    minutes: int = 15,
    metric: str = "rows",
    limit: int = 10,
    day: str | None = None,
) -> DataFrame:
    """Trailing-window ranking per day by rows, turnover or volume, ties by symbol."""
    metric = (metric or "rows").strip().lower()
    if metric not in TOP_METRICS:
        raise ValueError(f"metric must be one of {', '.join(TOP_METRICS)}")
    ranked = (
        trailing_window(ticks, minutes, day)
        .groupBy("trading_day", "symbol")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.round(F.coalesce(F.sum("turnover"), F.lit(0.0)), 3).alias("turnover"),
            F.coalesce(F.sum("volume"), F.lit(0)).alias("volume"),
            F.max("ts_ms").alias("latest_ts_ms"),
        )
    )
    order = Window.partitionBy("trading_day").orderBy(F.col(metric).desc(), "symbol")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def latest_ticks(ticks: DataFrame, n: int = 20, symbol: str | None = None) -> DataFrame:
    """Newest ticks of one symbol (a top-k), or of every symbol (pruned per task before the
    shuffle). Equal times are ordered by seq, then by ingest ordinal where there is one."""
    tie = [F.col("ts_ms").desc(), F.col("seq").desc_nulls_last()]
    if "ingest_ordinal" in ticks.columns:
        tie.append(F.col("ingest_ordinal").desc())
    if symbol is not None:
        return ticks.where(F.col("symbol") == symbol).orderBy(*tie).limit(n)
    order = Window.partitionBy("symbol").orderBy(*tie)
    return ticks.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def distinct_symbols(ticks: DataFrame) -> DataFrame:
    return ticks.where(F.coalesce("symbol", F.lit("")) != "").select("symbol").distinct()


def lower_rank_percentiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probs: Sequence[float],
    bucket_width: float,
) -> DataFrame:
    """The element at 0-based position ``int((n - 1) * p)`` of each group's sorted values.

    Exact and without sorting a whole group in one task: equal values are counted first, bucket
    totals give the bucket that holds each wanted position, and only inside that bucket values are
    ordered. ``bucket_width`` bounds the distinct values per bucket.
    """
    keys = list(groups)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_b", F.floor(F.col("_v") / bucket_width))
    )
    totals = counts.groupBy(*keys, "_b").agg(F.sum("_n").alias("_bn"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = totals.withColumn("_end", F.sum("_bn").over(upto)).withColumn(
        "_total", F.sum("_bn").over(group)
    )
    wanted = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(float(p)).alias("p"),
                    F.floor((F.col("_total") - 1) * float(max(0.0, min(1.0, p)))).alias("pos"),
                )
                for p in probs
            ]
        )
    )
    target = (
        placed.withColumn("_w", wanted)
        .where(
            (F.col("_w.pos") >= F.col("_end") - F.col("_bn")) & (F.col("_w.pos") < F.col("_end"))
        )
        .select(
            *keys,
            "_b",
            F.col("_w.p").alias("p"),
            (F.col("_w.pos") - (F.col("_end") - F.col("_bn"))).alias("_inner"),
        )
    )
    inside = Window.partitionBy(*keys, "_b", "p").orderBy("_v")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counts.join(target, [*keys, "_b"])
        .withColumn("_upto", F.sum("_n").over(running))
        .where(
            (F.col("_inner") < F.col("_upto")) & (F.col("_inner") >= F.col("_upto") - F.col("_n"))
        )
        .select(*keys, "p", F.col("_v").alias("value"))
    )


def ingest_per_minute(ticks: DataFrame, outcome: str | None = None) -> DataFrame:
    """Rows per receive minute and origin, with stored and dropped rows where flagged."""
    counts = [F.count(F.lit(1)).alias("rows")]
    if outcome is not None:
        for name in ("kept", "duplicate", "filtered"):
            counts.append(F.count_if(F.col(outcome) == name).alias(name))
    minute = (F.floor(F.col("recv_ts_ms") / 60_000) * 60_000).cast("bigint")
    return ticks.groupBy(minute.alias("minute_ms"), "push_type").agg(*counts)


def write_summary(batches: DataFrame, window_ms: int = 60_000) -> DataFrame:
    """Per window of commit times: batches, rates per minute and commit latency p50/p95.

    ``batches`` has committed_at_ms, inserted, ignored, commit_latency_ms.
    """
    rows = batches.withColumn(
        "window_ms", (F.floor(F.col("committed_at_ms") / window_ms) * window_ms).cast("bigint")
    )
    base = rows.groupBy("window_ms").agg(
        F.count(F.lit(1)).alias("batches"),
        F.floor(F.sum("inserted") * 60_000 / window_ms).cast("bigint").alias("inserted_per_min"),
        F.floor(F.sum("ignored") * 60_000 / window_ms).cast("bigint").alias("ignored_per_min"),
    )
    ranks = lower_rank_percentiles(
        rows, ["window_ms"], "commit_latency_ms", (0.50, 0.95), bucket_width=100.0
    )
    wide = ranks.groupBy("window_ms").agg(
        F.max(F.when(F.col("p") == 0.50, F.col("value"))).alias("latency_p50_ms"),
        F.max(F.when(F.col("p") == 0.95, F.col("value"))).alias("latency_p95_ms"),
    )
    return base.join(wide, "window_ms", "left")


def with_local_times(df: DataFrame, tz: str = DEFAULT_TZ, **columns: str) -> DataFrame:
    """``with_local_times(df, latest_local="latest_ts_ms")`` adds rendered local times."""
    return df.withColumns({k: clock.local_text(v, tz) for k, v in columns.items()})


def export_positions(
    ticks: DataFrame,
    ordinal: Sequence[str] = ("ingest_ordinal",),
    slice_ms: int = 600_000,
) -> DataFrame:
    """Each tick with its ``position`` within day and symbol, in export order: ts_ms, seq (missing as
    -1), ordinal.

    Ticks are ranked only within a time slice; the rows of earlier slices come from slice counts, so no
    symbol is gathered in one task.
    """
    cell = ["trading_day", "symbol", "_slice"]
    cut = ticks.withColumn("_slice", F.floor(F.col("ts_ms") / slice_ms))
    counts = cut.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy("trading_day", "symbol")
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select(*cell, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    order = Window.partitionBy(*cell).orderBy("ts_ms", F.coalesce("seq", F.lit(-1)), *ordinal)
    return (
        cut.withColumn("_rn", F.row_number().over(order))
        .join(starts, cell)
        .select(*ticks.columns, (F.col("_start") + F.col("_rn")).alias("position"))
    )
