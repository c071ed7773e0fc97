"""Minute features: activity, OHLC, order flow, impact, position against day levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import MicroParams

def tick_order() -> list[Column]:
    """Arrival-free total order of one symbol's ticks: time, seq, then price and volume."""
    return [
        F.col("ts_ms"),
        F.coalesce(F.col("seq"), F.lit(-1)),
        F.col("price"),
        F.col("volume"),
    ]


def _slice_ms(params: MicroParams) -> int:
    """A multiple of the bucket, so a bucket never spans two slices."""
    return params.bucket_ms * max(1, 600_000 // params.bucket_ms)


def tick_sides(ticks: DataFrame, params: MicroParams) -> DataFrame:
    """Adds ``tick_sign`` (+1, -1, NULL before the first move) and ``price_step``.

    Up is a buy, down a sell, unchanged carries the last sign on within symbol and trading day.
    The carry runs over time slices: inside a slice by a window, across slices by one summary row
    each, so a busy symbol is never ordered in one task. ``price_step`` is the move from the previous
    tick of the same slice.
    """
    scope = ["symbol", "trading_day"]
    cut = ticks.where(F.col("price").isNotNull()).withColumn(
        "_slice", F.floor(F.col("ts_ms") / _slice_ms(params))
    )
    order = Window.partitionBy(*scope, "_slice").orderBy(*tick_order())
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.col("price") - F.lag("price").over(order)
    moved = (
        cut.withColumns(
            {
                "price_step": step,
                "_prev_ts": F.lag("ts_ms").over(order),
                "_rn": F.row_number().over(order),
            }
        )
        .withColumn("_move", F.nullif(F.signum("price_step"), F.lit(0.0)))
        .withColumn("_inside", F.last("_move", ignorenulls=True).over(upto))
    )
    # The slice ends need no ordered pass: the last move of a slice leads from the price that was
    # last seen second latest to the one last seen. Prices are combined on the map side.
    place = F.struct(*[c.alias(f"o{n}") for n, c in enumerate(tick_order())])
    per_price = cut.groupBy(*scope, "_slice", "price").agg(
        F.min(place).alias("_lo"), F.max(place).alias("_hi")
    )
    cell = Window.partitionBy(*scope, "_slice")
    newest = cell.orderBy(F.col("_hi").desc())
    ends = (
        per_price.select(
            *scope,
            "_slice",
            F.row_number().over(newest).alias("_n"),
            F.col("price").alias("_last"),
            F.lead("price").over(newest).alias("_other"),
            F.min_by("price", "_lo").over(cell).alias("_first"),
        )
        .where("_n = 1")
        .withColumn("_end", F.signum(F.col("_last") - F.col("_other")))
    )
    by_slice = Window.partitionBy(*scope).orderBy("_slice")
    edge = F.nullif(F.signum(F.col("_first") - F.lag("_last").over(by_slice)), F.lit(0.0))
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ends.withColumn("_edge", edge)
        .withColumn(
            "_start",
            F.coalesce(
                "_edge", F.last(F.coalesce("_end", "_edge"), ignorenulls=True).over(earlier)
            ),
        )
        .select(*scope, "_slice", "_start")
    )
    return moved.join(starts, [*scope, "_slice"]).withColumn(
        "tick_sign", F.coalesce("_inside", "_start")
    )


def minute_features(ticks: DataFrame, params: MicroParams) -> DataFrame:
    """One row per bucket and symbol. A missing direction is inferred by the tick rule.

    The bucket aggregation keeps the partitioning of the tick-rule window (its keys are among the
    grouping keys), so it needs no further shuffle.
    """
    bucket = (F.floor(F.col("ts_ms") / params.bucket_ms) * params.bucket_ms).cast("bigint")
    sided = tick_sides(ticks, params).withColumn("ts_min_ms", bucket)
    known = F.col("direction").isin("BUY", "SELL")
    is_buy = F.when(known, F.col("direction") == "BUY").otherwise(F.col("tick_sign") > 0)
    is_sell = F.when(known, F.col("direction") == "SELL").otherwise(F.col("tick_sign") < 0)
    volume = F.coalesce(F.col("volume"), F.lit(0))
    jump = (F.abs(F.col("price_step")) >= params.jump_ticks * params.tick_size - params.eps) & (
        F.col("_prev_ts") >= F.col("ts_min_ms")
    )
    grouped = sided.groupBy("symbol", "trading_day", "_slice", "ts_min_ms").agg(
        F.count(F.lit(1)).alias("ticks"),
        F.sum(volume).alias("volume"),
        F.sum(F.coalesce(F.col("turnover"), F.col("price") * volume)).alias("turnover"),
        F.min_by("price", "_rn").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "_rn").alias("close"),
        F.sum(F.when(is_buy, volume).otherwise(0)).alias("buy_volume"),
        F.sum(F.when(is_sell, volume).otherwise(0)).alias("sell_volume"),
        F.count_if(jump).alias("jump_count"),
    )
    change = F.col("close") - F.col("open")
    signed = F.col("buy_volume") - F.col("sell_volume")
    sided_volume = F.col("buy_volume") + F.col("sell_volume")
    return grouped.select(
        "ts_min_ms",
        "symbol",
        "trading_day",
        "ticks",
        "volume",
        "turnover",
        "open",
        "high",
        "low",
        "close",
        "buy_volume",
        "sell_volume",
        (signed / (sided_volume + params.eps)).alias("imbalance"),
        (F.abs(change) / F.col("open")).alias("abs_return"),
        change.alias("price_change"),
        (F.abs(change) / (F.col("volume") + params.eps)).alias("impact"),
        "jump_count",
    )


def levels_before(features: DataFrame, levels: DataFrame) -> DataFrame:
    """As-of form of the levels: for each symbol and day the newest earlier day's levels."""
    body = [c for c in levels.columns if c not in ("symbol", "trading_day")]
    days = (
        features.select("symbol", "trading_day")
        .union(levels.select("symbol", "trading_day"))
        .distinct()
    )
    packed = levels.select("symbol", "trading_day", F.struct(*body).alias("_levels"))
    earlier = (
        Window.partitionBy("symbol")
        .orderBy("trading_day")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        days.join(packed, ["symbol", "trading_day"], "left")
        .withColumn("_levels", F.last("_levels", ignorenulls=True).over(earlier))
        .where("_levels IS NOT NULL")
        .select("symbol", "trading_day", "_levels.*")
    )


def with_levels(features: DataFrame, levels: DataFrame, params: MicroParams) -> DataFrame:
    """Adds level columns and the position against them.

    ``same_day`` looks ahead within the day; ``prev_day`` uses only what was known before it.
    """
    if params.levels_mode == "prev_day":
        levels = levels_before(features, levels)
    elif params.levels_mode != "same_day":
        raise ValueError(f"levels_mode: {params.levels_mode}")
    wanted = levels.select("symbol", "trading_day", "poc", "vah", "val", "hvn", "lvn")
    joined = features.join(wanted, ["symbol", "trading_day"], "left")
    inside = F.col("close").between(F.col("val"), F.col("vah"))
    return joined.withColumns(
        {
            "dist_to_poc": F.col("close") - F.col("poc"),
            "in_value_area": inside.cast("int"),
            "above_vah": (F.col("close") > F.col("vah")).cast("int"),
            "below_val": (F.col("close") < F.col("val")).cast("int"),
        }
    )


def _sorted_values(items: str, field: str) -> Column:
    values = F.transform(items, lambda item: item[field].cast("double"))
    return F.array_sort(F.filter(values, lambda v: v.isNotNull()))


def _percentile(ordered: Column, prob: float) -> Column:
    """The interpolated percentile of an ascending list."""
    place = (F.size(ordered) - 1) * F.lit(float(prob))
    low, high = F.floor(place).cast("int"), F.ceil(place).cast("int")
    below, above = F.get(ordered, low), F.get(ordered, high)
    return F.when(low == high, below).otherwise(below * (high - place) + above * (place - low))


def with_gates(features: DataFrame, params: MicroParams) -> DataFrame:
    """Trailing percentiles of each feature over the short and long lookback, without the current
    bucket; NULL with too little history.

    All frames share one partitioning and ordering. A symbol's time axis is cut into slices, and the
    buckets a later slice looks back on are copied into it, so a partition holds a bounded number of
    buckets however long the history is.
    """
    halo_ms = max(params.long_ms, params.short_ms) + params.compress_ms
    slice_ms = max(86_400_000, halo_ms)
    own = F.floor(F.col("ts_min_ms") / slice_ms)
    near_end = F.col("ts_min_ms") >= (F.col("_own") + 1) * slice_ms - halo_ms
    spread = features.withColumn("_own", own).withColumn(
        "_slice",
        F.explode(
            F.when(near_end, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(
                F.array(F.col("_own"))
            )
        ),
    )
    order = Window.partitionBy("symbol", "_slice").orderBy("ts_min_ms")
    short = order.rangeBetween(-params.short_ms, -1)
    long = order.rangeBetween(-params.long_ms, -1)
    recent = order.rangeBetween(-(params.compress_ms - params.bucket_ms), 0)
    ranged = spread.withColumn(
        "recent_range", F.max("high").over(recent) - F.min("low").over(recent)
    )

    # each frame is collected once; every percentile reads a sorted list of its feature
    framed = ranged.withColumns(
        {
            "_short": F.collect_list(F.struct("abs_return", "impact", "volume")).over(short),
            "_long": F.collect_list(F.struct("impact", "recent_range", "ticks")).over(long),
        }
    )
    mine = framed.where(F.col("_slice") == F.col("_own"))
    lists = {
        "_ret": ("_short", "abs_return"),
        "_imp": ("_short", "impact"),
        "_vol": ("_short", "volume"),
        "_vac": ("_long", "impact"),
        "_rng": ("_long", "recent_range"),
        "_tck": ("_long", "ticks"),
    }
    listed = mine.withColumns({k: _sorted_values(c, f) for k, (c, f) in lists.items()})
    wanted = {
        "ret_absorb": ("_ret", params.absorb_ret_pctl),
        "ret_reject": ("_ret", params.reject_ret_pctl),
        "ret_init": ("_ret", params.init_ret_pctl),
        "impact_median": ("_imp", 0.5),
        "impact_init": ("_imp", params.init_impact_pctl),
        "volume_absorb": ("_vol", params.absorb_vol_pctl),
        "impact_vacuum": ("_vac", params.vacuum_impact_pctl),
        "range_compress": ("_rng", params.compress_range_pctl),
        "ticks_compress": ("_tck", params.compress_ticks_pctl),
    }

    def gate(name: str, prob: float) -> Column:
        frame = lists[name][0]
        return F.when(F.size(frame) >= params.min_history, _percentile(F.col(name), prob))

    out = listed.withColumns({k: gate(c, p) for k, (c, p) in wanted.items()})
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return out.withColumns(
        {
            "compression_score": ratio("recent_range", "range_compress"),
            "release_score": ratio("impact", "impact_init"),
        }
    ).drop(*lists, "_short", "_long", "_own", "_slice")


def latest_features(features: DataFrame, symbol: str, n: int = 120) -> DataFrame:
    return features.where(F.col("symbol") == symbol).orderBy(F.col("ts_min_ms").desc()).limit(n)
