"""Holiday list source and calendar lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock
from ..params import DEFAULT_TZ


def parse_holidays(lines: DataFrame, column: str = "value") -> DataFrame:
    """One day per line, ``#`` comments, first comma field; lines that are no day are dropped."""
    text = F.trim(F.col(column))
    first = F.substring_index(text, ",", 1)
    return (
        lines.where((text != "") & ~text.startswith("#"))
        .select(clock.calendar_day(first).alias("trading_day"))
        .where("trading_day IS NOT NULL")
        .distinct()
    )


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    return parse_holidays(spark.read.text(path))


def merge_holidays(file_days: DataFrame, inline: Sequence[str] = ()) -> DataFrame:
    """Days of the file and of the given list, each once."""
    if not inline:
        return file_days.select("trading_day").distinct()
    spark = file_days.sparkSession
    given = spark.createDataFrame([(str(d),) for d in inline], "value string")
    return file_days.select("trading_day").union(parse_holidays(given)).distinct()


def with_holidays(df: DataFrame, day: str, holidays: DataFrame, name: str = "is_holiday") -> DataFrame:
    """Adds whether the day is one of the holidays, by a left join that the planner gives its form."""
    listed = holidays.select(F.col("trading_day").alias("_holiday")).distinct()
    joined = df.join(listed, F.col(day) == F.col("_holiday"), "left")
    return joined.withColumn(name, F.col("_holiday").isNotNull()).drop("_holiday")


def with_market_state(
    df: DataFrame, ts_ms: str, holidays: DataFrame | None = None, tz: str = DEFAULT_TZ
) -> DataFrame:
    """Adds local ``market_day``, ``market_mode``, ``is_trading_day`` and ``is_trading_session``.
    """
    out = df.withColumn("market_day", clock.trading_day(ts_ms, tz))
    holiday = None
    if holidays is not None:
        out = with_holidays(out, "market_day", holidays, "_h")
        holiday = F.col("_h")
    out = out.withColumns(
        {
            "market_mode": clock.market_phase(ts_ms, holiday, tz),
            "is_trading_day": clock.is_trading_day(ts_ms, holiday, tz),
        }
    )
    out = out.withColumn("is_trading_session", F.col("market_mode") == "open")
    return out.drop("_h") if holidays is not None else out
