"""Daily quality: report, grade, validation verdict, status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock
from ..params import QualityParams
from . import gaps as gap_ops
from . import stats


def grade(rows: Column, gap_total: Column, largest: Column, stall_total: Column) -> Column:
    return (
        F.when(rows <= 0, "D")
        .when((largest > 120) | (gap_total > 900), "D")
        .when((largest > 60) | (gap_total > 300), "C")
        .when((gap_total > 0) | (stall_total > 120), "B")
        .otherwise("A")
    )


def suggestion(rows: Column, grade_col: Column) -> Column:
    """A short hint per grade."""
    return (
        F.when(rows <= 0, "no ticks: check the feed and the trading hours")
        .when(grade_col == "D", "severe gaps: backfill after the close and validate again")
        .when(grade_col == "C", "gaps above a minute: backfill the affected symbols")
        .when(grade_col == "B", "short gaps or stalls: spot-check the main symbols")
        .otherwise("continuous: ready for use")
    )


def requested_days(spark, days: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in days], "trading_day string")


def daily_report(
    ticks: DataFrame,
    gaps: DataFrame,
    params: QualityParams,
    now_ms: int,
    *,
    days: DataFrame | None = None,
    top_n: int = 20,
    ticks_table: bool = True,
    gaps_table: bool = True,
) -> DataFrame:
    """One flat row per day, with the top lists as arrays.

    Ticks are read twice: once for the per-symbol counts (day totals are summed from them), once for
    the distinct tick times of the stall scan. Everything joined afterwards is one row per day.
    ``days`` adds days without data; by default the days of the data are reported.
    """
    top_n = max(1, int(top_n))
    per_symbol = stats.symbol_stats(ticks)
    totals = stats.coverage(stats.day_stats_from_symbols(per_symbol), now_ms)
    top_symbols = (
        stats.with_local_times(
            stats.top_rows(per_symbol, top_n), params.tz, latest_local="latest_ts_ms"
        )
        .groupBy("trading_day")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("rank", "symbol", "rows", "latest_ts_ms", "latest_local"))
            ).alias("rows_per_symbol")
        )
    )
    gap_totals = gap_ops.gap_totals(gaps)
    gap_top = (
        gap_ops.gaps_by_symbol(gaps, top_n)
        .groupBy("trading_day")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("rank", "symbol", "gaps", "total_gap_sec", "largest_gap_sec")
                )
            ).alias("gaps_by_symbol")
        )
    )
    stalls = gap_ops.soft_stalls(ticks, params)
    stall_totals = gap_ops.stall_totals(stalls)
    stall_top = (
        stats.with_local_times(
            gap_ops.top_stalls(stalls, top_n),
            params.tz,
            stall_start_local="stall_start_ts_ms",
            stall_end_local="stall_end_ts_ms",
        )
        .groupBy("trading_day")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "rank",
                        "symbol",
                        F.round("stall_sec", 3).alias("stall_sec"),
                        "stall_start_ts_ms",
                        "stall_end_ts_ms",
                        "stall_start_local",
                        "stall_end_local",
                    )
                )
            ).alias("soft_stalls")
        )
    )
    base = totals if days is None else days.distinct().join(totals, "trading_day", "left")
    joined = base
    for side in (top_symbols, gap_totals, gap_top, stall_totals, stall_top):
        joined = joined.join(side, "trading_day", "left")
    zero = {
        "total_rows": 0,
        "duration_sec": 0.0,
        "hard_gaps_total": 0,
        "hard_gaps_total_sec": 0.0,
        "largest_gap_sec": 0.0,
        "soft_stalls_total": 0,
        "soft_stalls_total_sec": 0.0,
        "largest_stall_sec": 0.0,
    }
    filled = joined.fillna(zero)
    graded = filled.withColumn(
        "quality_grade",
        grade(
            F.col("total_rows"),
            F.col("hard_gaps_total_sec"),
            F.col("largest_gap_sec"),
            F.col("soft_stalls_total_sec"),
        ),
    )
    return graded.withColumns(
        {
            "day_dashed": clock.dashed_day("trading_day"),
            "start_local": clock.local_text("start_ts_ms", params.tz),
            "end_local": clock.local_text("end_ts_ms", params.tz),
            "generated_at_ms": F.lit(now_ms).cast("bigint"),
            "warnings": day_flags(
                (F.col("total_rows") > 0) | (F.col("hard_gaps_total") > 0), ticks_table, gaps_table
            ),
            "suggestion": suggestion(F.col("total_rows"), F.col("quality_grade")),
        }
    )


def day_flags(known: Column, ticks_table: bool, gaps_table: bool) -> Column:
    """A day occurring in no table is ``db_not_found``; a known day may lack a whole table."""
    return F.array_compact(
        F.array(
            F.when(~known, F.lit("db_not_found")),
            F.when(known & F.lit(not ticks_table), F.lit("ticks_table_missing")),
            F.when(known & F.lit(not gaps_table), F.lit("gaps_table_missing")),
        )
    )


def nested_report(report: DataFrame) -> DataFrame:
    """The report as nested sections, as written to JSON."""
    return report.select(
        "trading_day",
        F.col("day_dashed").alias("trading_day_dashed"),
        "generated_at_ms",
        F.struct(
            "start_ts_ms", "end_ts_ms", "start_local", "end_local", "duration_sec",
            "last_tick_age_sec",
        ).alias("coverage"),
        F.struct("total_rows", "rows_per_symbol").alias("volume"),
        F.struct(
            "hard_gaps_total", "hard_gaps_total_sec", "largest_gap_sec", "gaps_by_symbol"
        ).alias("gaps"),
        F.struct(
            "soft_stalls_total", "soft_stalls_total_sec", "largest_stall_sec", "soft_stalls",
            "warnings",
        ).alias("observations"),
        F.struct("quality_grade", "suggestion").alias("conclusion"),
    )


def write_reports(report: DataFrame, path: str) -> None:
    """One JSON folder per day; only the reported days are replaced."""
    (
        nested_report(report)
        .hint("rebalance", "trading_day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("trading_day")
        .json(path)
    )


def daily_quality_rows(report: DataFrame, created_at_ms: int, host: str) -> DataFrame:
    return report.select(
        "trading_day",
        F.lit(created_at_ms).cast("bigint").alias("created_at_ms"),
        F.lit(host).alias("host"),
        F.to_json("rows_per_symbol").alias("symbols_json"),
        F.to_json(
            F.struct(
                "total_rows", "hard_gaps_total", "hard_gaps_total_sec", "largest_gap_sec",
                "soft_stalls_total", "quality_grade",
            )
        ).alias("summary_json"),
    )


def validate(
    days: DataFrame,
    ticks: DataFrame,
    gaps: DataFrame,
    now_ms: int,
    *,
    strict: bool = False,
    ticks_table: bool = True,
    gaps_table: bool = True,
) -> DataFrame:
    """PASS, WARN or FAIL per requested day, with reasons and warnings."""
    day_rows = ticks.groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("rows"), F.max("ts_ms").alias("max_ts_ms")
    )
    facts = (
        days.join(day_rows, "trading_day", "left")
        .join(gap_ops.gap_totals(gaps), "trading_day", "left")
        .withColumn("_known", F.col("rows").isNotNull() | F.col("hard_gaps_total").isNotNull())
        .fillna({"rows": 0, "hard_gaps_total_sec": 0.0, "largest_gap_sec": 0.0})
    )
    max_ts, rows, known = F.col("max_ts_ms"), F.col("rows"), F.col("_known")
    has_table = known & F.lit(ticks_table)
    hard_reasons = F.array_compact(
        F.array(
            F.when(~known, F.lit("db_not_found")),
            F.when(known & F.lit(not ticks_table), F.lit("ticks_table_missing")),
            F.when(has_table & (rows <= 0), F.lit("ticks_count_is_zero")),
            F.when(has_table & max_ts.isNull(), F.lit("ticks_max_ts_missing")),
            F.when(max_ts > now_ms + 300_000, F.lit("ticks_max_ts_too_far_in_future")),
        )
    )
    gap_bad = (F.col("largest_gap_sec") > 60.0) | (F.col("hard_gaps_total_sec") > 300.0)
    strict_on = F.lit(strict) & (F.size("_hard") == 0)
    warnings = F.array_compact(
        F.array(
            F.when(
                (max_ts <= now_ms + 300_000) & (max_ts > now_ms + 60_000),
                F.lit("ticks_max_ts_slightly_in_future"),
            ),
            F.when(known & F.lit(not gaps_table), F.lit("gaps_table_missing")),
            F.when(~known, F.lit("quality_report_not_generated")),
            F.when(
                strict_on & ~gap_bad & (F.col("hard_gaps_total_sec") > 0),
                F.lit("strict_mode_gap_observed"),
            ),
        )
    )
    reasons = F.when(
        strict_on & gap_bad,
        F.array_append("_hard", F.lit("strict_mode_gap_threshold_exceeded")),
    ).otherwise(F.col("_hard"))
    judged = (
        facts.withColumn("_hard", hard_reasons)
        .withColumn("reasons", reasons)
        .withColumn("warnings", warnings)
    )
    status = (
        F.when(F.size("reasons") > 0, "FAIL").when(F.size("warnings") > 0, "WARN").otherwise("PASS")
    )
    return judged.select(
        "trading_day",
        status.alias("status"),
        "reasons",
        "warnings",
        "rows",
        "max_ts_ms",
        F.round("largest_gap_sec", 3).alias("largest_gap_sec"),
        F.round("hard_gaps_total_sec", 3).alias("hard_gaps_total_sec"),
    )


def day_warnings(
    days: DataFrame, ticks: DataFrame, *, ticks_table: bool = True, gaps_table: bool = True
) -> DataFrame:
    """Warning flags of each requested day, whether it has data or not."""
    present = ticks.select("trading_day").distinct().withColumn("_present", F.lit(True))
    known = F.col("_present").isNotNull()
    return days.join(present, "trading_day", "left").select(
        "trading_day", day_flags(known, ticks_table, gaps_table).alias("warnings")
    )


def status(
    ticks: DataFrame,
    gaps: DataFrame,
    now_ms: int,
    symbols: Sequence[str] = (),
    top_n: int = 20,
    *,
    pre_filter: bool = False,
) -> DataFrame:
    """Day totals with the busiest symbols of the day, one row per day and shown symbol."""
    per_symbol = stats.symbol_stats(ticks)
    totals = stats.coverage(stats.day_stats_from_symbols(per_symbol), now_ms)
    gap_facts = gap_ops.gap_totals(gaps).select(
        "trading_day", F.col("hard_gaps_total").alias("gaps_total"), "largest_gap_sec"
    )
    shown = stats.status_symbols(per_symbol, symbols, top_n, pre_filter=pre_filter).select(
        "trading_day",
        "rank",
        "symbol",
        "rows",
        "latest_ts_ms",
        stats.age_sec("latest_ts_ms", now_ms).alias("symbol_age_sec"),
    )
    return (
        totals.join(gap_facts, "trading_day", "left")
        .fillna({"gaps_total": 0, "largest_gap_sec": 0.0})
        .join(shown, "trading_day", "left")
    )
