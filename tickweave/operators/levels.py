"""Volume profile per day and symbol, and the day levels read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock
from ..params import MicroParams

DAY = ["trading_day", "symbol"]


def _within(bounds: tuple[int, int], tz: str) -> Column:
    ms = F.pmod(clock.local_ms("ts_ms", tz), F.lit(clock.DAY_MS))
    return (ms >= bounds[0] * 1000) & (ms < bounds[1] * 1000)


def day_profile(ticks: DataFrame, params: MicroParams) -> DataFrame:
    """Volume per price bin, with everything later day figures need, in one pass over the ticks.

    The aggregation combines on the map side; a symbol-day has as many rows as price bins.
    """
    volume = F.coalesce(F.col("volume"), F.lit(0))
    price_bin = F.floor(F.round(F.col("price") / params.price_bin, 6)).cast("bigint")
    stamp = F.struct(
        "ts_ms", F.coalesce("seq", F.lit(-1)).alias("seq"), F.col("price"), F.col("volume")
    )
    rows = ticks.where(F.col("price").isNotNull()).select(
        *DAY,
        "price",
        volume.alias("_vol"),
        F.coalesce(F.col("turnover"), F.col("price") * volume).alias("_turnover"),
        price_bin.alias("bin"),
        stamp.alias("_at"),
        _within(params.open_auction, params.tz).alias("_open"),
        _within(params.open_confirm, params.tz).alias("_confirm"),
        _within(params.close_auction, params.tz).alias("_close"),
    )

    def only(flag: str, name: str) -> Column:
        return F.when(F.col(flag), F.col(name))

    return rows.groupBy(*DAY, "bin").agg(
        F.sum("_vol").alias("vol"),
        F.sum("_turnover").alias("turnover"),
        F.count(F.lit(1)).alias("ticks"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max("_at").alias("last_at"),
        F.coalesce(F.sum(only("_open", "_vol")), F.lit(0)).alias("open_vol"),
        F.max(only("_open", "price")).alias("open_high"),
        F.min(only("_open", "price")).alias("open_low"),
        F.min(only("_open", "_at")).alias("open_first"),
        F.max(only("_open", "_at")).alias("open_last"),
        F.min(only("_confirm", "_at")).alias("confirm_first"),
        F.max(only("_confirm", "_at")).alias("confirm_last"),
        F.coalesce(F.sum(only("_close", "_vol")), F.lit(0)).alias("close_vol"),
        F.max(only("_close", "price")).alias("close_high"),
        F.min(only("_close", "price")).alias("close_low"),
    )


def volume_profile(ticks: DataFrame, params: MicroParams) -> DataFrame:
    return day_profile(ticks, params).select(
        *DAY, (F.col("bin") * params.price_bin).alias("price"), "vol"
    )


def _figure_aggs() -> dict[str, Column]:
    return {
        "total_volume": F.sum("vol"),
        "total_turnover": F.sum("turnover"),
        "high": F.max("high"),
        "low": F.min("low"),
        "last_at": F.max("last_at"),
        "open_vol": F.sum("open_vol"),
        "open_high": F.max("open_high"),
        "open_low": F.min("open_low"),
        "open_first": F.min("open_first"),
        "open_last": F.max("open_last"),
        "confirm_first": F.min("confirm_first"),
        "confirm_last": F.max("confirm_last"),
        "close_vol": F.sum("close_vol"),
        "close_high": F.max("close_high"),
        "close_low": F.min("close_low"),
    }


def _with_figures(days: DataFrame) -> DataFrame:
    close = F.col("last_at.price")
    span = F.col("high") - F.col("low")
    return days.withColumns(
        {
            "close": close,
            "open_auc_range": F.col("open_high") - F.col("open_low"),
            "close_auc_range": F.col("close_high") - F.col("close_low"),
            "close_strength_score": F.when(span > 0, (close - F.col("low")) / span),
        }
    )


def _ranked(profile: DataFrame, params: MicroParams) -> DataFrame:
    """Bins with their volume ranks, value-area membership and neighbour volumes. The orderings share
    one partitioning, and the day aggregation after them needs no further shuffle."""
    whole = Window.partitionBy(*DAY)
    by_volume = whole.orderBy(F.col("vol").desc(), "bin")
    by_price = whole.orderBy("bin")
    upto = by_volume.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = profile.withColumns(
        {
            "_rank": F.row_number().over(by_volume),
            "_before": F.sum("vol").over(upto) - F.col("vol"),
            "_all": F.sum("vol").over(whole),
            "_lo": F.lag("vol").over(by_price),
            "_hi": F.lead("vol").over(by_price),
            "_price": F.col("bin") * params.price_bin,
            "_open_rank": F.row_number().over(whole.orderBy(F.col("open_vol").desc(), "bin")),
        }
    )
    inside = (F.col("_rank") == 1) | (F.col("_before") < F.col("_all") * params.value_area)
    return marked.withColumn("_inside", inside)


def _area_aggs() -> dict[str, Column]:
    inside = F.when(F.col("_inside"), F.col("_price"))
    return {
        "poc": F.max(F.when(F.col("_rank") == 1, F.col("_price"))),
        "vah": F.max(inside),
        "val": F.min(inside),
    }


def _node_aggs() -> dict[str, Column]:
    node = F.struct(F.col("_price").alias("price"), F.col("vol").alias("vol"))
    high = (F.col("vol") > F.col("_lo")) & (F.col("vol") > F.col("_hi"))
    low = (F.col("vol") < F.col("_lo")) & (F.col("vol") < F.col("_hi"))
    return {
        "hvn": F.sort_array(F.collect_list(F.when(high, node))),
        "lvn": F.sort_array(F.collect_list(F.when(low, node))),
    }


def _per_day(rows: DataFrame, *aggs: dict[str, Column]) -> DataFrame:
    merged = {k: v for part in aggs for k, v in part.items()}
    return rows.groupBy(*DAY).agg(*[v.alias(k) for k, v in merged.items()])


def value_area(profile: DataFrame, params: MicroParams) -> DataFrame:
    """POC, VAH and VAL: bins by volume (ties: lower price) until the value-area share is reached."""
    return _per_day(_ranked(profile, params), _area_aggs())


def volume_nodes(profile: DataFrame, params: MicroParams) -> DataFrame:
    """High and low volume nodes: strict local extremes against the neighbouring traded bins."""
    return _per_day(_ranked(profile, params), _node_aggs())


def day_levels(profile: DataFrame, params: MicroParams) -> DataFrame:
    """Everything known per day and symbol, in one pass over the profile."""
    top3 = {"open_top3": F.sum(F.when(F.col("_open_rank") <= 3, F.col("open_vol")))}
    days = _per_day(
        _ranked(profile, params), _area_aggs(), _node_aggs(), _figure_aggs(), top3
    )
    return _with_figures(days).withColumn("calc_version", F.lit(params.calc_version))


LEVEL_COLUMNS = (
    "trading_day", "symbol", "poc", "vah", "val", "hvn", "lvn", "total_volume", "total_turnover",
    "open_auc_range", "close_auc_range", "close_strength_score", "high", "low", "close",
    "open_vol", "close_vol", "calc_version",
)


def levels_daily(profile: DataFrame, params: MicroParams) -> DataFrame:
    """One row per day and symbol; ``hvn`` and ``lvn`` are node arrays."""
    return day_levels(profile, params).select(*LEVEL_COLUMNS)
