"""Gap and stall detection over distinct tick times.

One window per symbol would put a very active symbol into one task. The time axis is cut into slices
instead: each point belongs to its slice, and points within the activity window of the slice end are
copied into the next slice, so every trailing count is complete inside its slice. A slice holds at
most one point per millisecond of slice plus window, whatever the number of ticks, since repeated
times are collapsed first by a partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock
from ..params import QualityParams
from ..schema import GAP_COLUMNS


def tick_points(
    ticks: DataFrame, params: QualityParams, *, per_day: bool = False
) -> DataFrame:
    """Distinct tick times with ``prev_ts_ms`` and ``active_count``.

    ``active_count`` counts distinct times in ``[ts - window, ts]``, the current one included.
    ``per_day`` starts afresh each trading day (report form); otherwise a symbol runs on over days.
    The previous time beyond the window is needed only when one tick makes a symbol active.
    """
    scope = ["symbol", "trading_day"] if per_day else ["symbol"]
    window_ms = params.window_ms
    slice_ms = max(params.slice_ms, window_ms)
    own = F.floor(F.col("ts_ms") / slice_ms).cast("bigint")
    points = (
        ticks.where(F.coalesce("symbol", F.lit("")) != "")
        .select("symbol", "trading_day", "ts_ms")
        .distinct()
        .withColumn("_own", own)
    )
    near_end = F.col("ts_ms") >= (F.col("_own") + 1) * slice_ms - window_ms
    spread = points.withColumn(
        "_slice",
        F.explode(
            F.when(near_end, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(
                F.array(F.col("_own"))
            )
        ),
    )
    part = Window.partitionBy(*scope, "_slice")
    prev = F.lag("ts_ms").over(part.orderBy("ts_ms", "trading_day"))
    fresh = F.col("_prev").isNull() | (F.col("_prev") < F.col("ts_ms"))
    # two running counts, each one pass; a frame that starts at -window_ms is counted anew for each row
    upto = part.orderBy("ts_ms").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = part.orderBy("ts_ms").rangeBetween(Window.unboundedPreceding, -window_ms - 1)
    distinct_times = F.count_if(F.col("_fresh"))
    counted = (
        spread.withColumn("_prev", prev)
        .withColumn("_fresh", fresh)
        .withColumn("active_count", distinct_times.over(upto) - distinct_times.over(before))
        .where((F.col("_slice") == F.col("_own")) & F.col("_fresh"))
    )
    if params.active_min_ticks <= 1:
        counted = _carry_previous(counted, points, scope)
    return counted.select(
        "symbol", "trading_day", "ts_ms", F.col("_prev").alias("prev_ts_ms"), "active_count"
    )


def _carry_previous(counted: DataFrame, points: DataFrame, scope: list[str]) -> DataFrame:
    """Fill the previous time of a slice's first point from the last earlier slice."""
    ends = points.groupBy(*scope, "_own").agg(F.max("ts_ms").alias("_end"))
    before = F.lag("_end").over(Window.partitionBy(*scope).orderBy("_own"))
    carried = ends.withColumn("_carry", before).select(*scope, "_own", "_carry")
    return counted.join(carried, [*scope, "_own"], "left").withColumn(
        "_prev", F.coalesce("_prev", "_carry")
    )


def previous_ticks(ticks: DataFrame, params: QualityParams, *, per_day: bool = False) -> DataFrame:
    """Previous distinct tick time per symbol, over any distance."""
    import dataclasses

    always = dataclasses.replace(params, active_min_ticks=1)
    return tick_points(ticks, always, per_day=per_day)


def same_session(prev: Column | str, curr: Column | str, params: QualityParams) -> Column:
    sessions = params.session_list
    left = clock.session_index(prev, sessions, params.tz)
    right = clock.session_index(curr, sessions, params.tz)
    return F.coalesce(left == right, F.lit(False))


def _quiet_spells(points: DataFrame, params: QualityParams) -> DataFrame:
    """Points of an active symbol whose previous tick lies in the same session."""
    sessions = params.session_list
    return (
        points.where(
            (F.col("active_count") >= params.active_min_ticks) & F.col("prev_ts_ms").isNotNull()
        )
        .withColumn("delta_ms", F.col("ts_ms") - F.col("prev_ts_ms"))
        .withColumn("_session", clock.session_index("ts_ms", sessions, params.tz))
        .where(F.col("_session") == clock.session_index("prev_ts_ms", sessions, params.tz))
    )


def hard_gaps(
    ticks: DataFrame, params: QualityParams, detected_at_ms: int, *, per_day: bool = False
) -> DataFrame:
    """GAPS rows: an active symbol silent for more than the threshold within one session."""
    spells = _quiet_spells(tick_points(ticks, params, per_day=per_day), params)
    return gaps_from_spells(spells, params, detected_at_ms)


def gaps_from_spells(spells: DataFrame, params: QualityParams, detected_at_ms: int) -> DataFrame:
    evidence = F.to_json(
        F.struct(
            F.col("prev_ts_ms"),
            F.col("ts_ms").alias("curr_ts_ms"),
            F.lit(float(params.gap_threshold_sec)).alias("gap_threshold_sec"),
            F.lit(int(params.active_window_sec)).alias("active_window_sec"),
            F.lit(int(params.active_min_ticks)).alias("active_min_ticks"),
            F.col("active_count"),
            clock.session_label(F.col("_session"), params.session_list).alias("session"),
        )
    )
    return spells.where(F.col("delta_ms") / 1000.0 > params.gap_threshold_sec).select(
        "trading_day",
        "symbol",
        F.col("prev_ts_ms").alias("gap_start_ts_ms"),
        F.col("ts_ms").alias("gap_end_ts_ms"),
        (F.col("delta_ms") / 1000.0).alias("gap_sec"),
        F.lit(detected_at_ms).cast("bigint").alias("detected_at_ms"),
        F.lit("hard_gap").alias("reason"),
        evidence.alias("meta_json"),
    ).select(*GAP_COLUMNS)


def soft_stalls(
    ticks: DataFrame, params: QualityParams, *, live: bool = False
) -> DataFrame:
    """Silences above the stall threshold.

    Report form: per trading day and independent of hard gaps. ``live`` keeps only those that are no
    hard gap and runs on over days.
    """
    spells = _quiet_spells(tick_points(ticks, params, per_day=not live), params)
    seconds = F.col("delta_ms") / 1000.0
    hit = seconds > params.stall_warn_sec
    if live:
        hit = hit & (seconds <= params.gap_threshold_sec)
    evidence = F.to_json(
        F.struct(
            F.col("prev_ts_ms"),
            F.col("ts_ms").alias("curr_ts_ms"),
            F.lit(float(params.stall_warn_sec)).alias("stall_warn_sec"),
            F.col("active_count"),
            clock.session_label(F.col("_session"), params.session_list).alias("session"),
        )
    )
    return spells.where(hit).select(
        "trading_day",
        "symbol",
        F.col("prev_ts_ms").alias("stall_start_ts_ms"),
        F.col("ts_ms").alias("stall_end_ts_ms"),
        seconds.alias("stall_sec"),
        "delta_ms",
        evidence.alias("meta_json"),
    )


def stall_totals(stalls: DataFrame) -> DataFrame:
    """Per day; milliseconds are summed, so the total depends on no addition order."""
    return stalls.groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("soft_stalls_total"),
        (F.sum("delta_ms") / 1000.0).alias("soft_stalls_total_sec"),
        (F.max("delta_ms") / 1000.0).alias("largest_stall_sec"),
    )


def top_stalls(stalls: DataFrame, n: int = 20) -> DataFrame:
    order = Window.partitionBy("trading_day").orderBy(
        F.col("delta_ms").desc(), "symbol", "stall_start_ts_ms"
    )
    return stalls.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _gap_ms() -> Column:
    return F.round(F.col("gap_sec") * 1000).cast("bigint")


def gap_totals(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("hard_gaps_total"),
        (F.sum(_gap_ms()) / 1000.0).alias("hard_gaps_total_sec"),
        (F.max(_gap_ms()) / 1000.0).alias("largest_gap_sec"),
    )


def gaps_by_symbol(gaps: DataFrame, n: int | None = 20) -> DataFrame:
    per_symbol = gaps.groupBy("trading_day", "symbol").agg(
        F.count(F.lit(1)).alias("gaps"),
        (F.sum(_gap_ms()) / 1000.0).alias("total_gap_sec"),
        (F.max(_gap_ms()) / 1000.0).alias("largest_gap_sec"),
    )
    if n is None:
        return per_symbol
    order = Window.partitionBy("trading_day").orderBy(F.col("gaps").desc(), "symbol")
    return per_symbol.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
