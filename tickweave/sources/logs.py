"""Log lines as a table, and the line filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text


def line_time(line) -> Column:
    """The time a line begins with, such as ``2024-01-02 03:04:05,678``, in UTC; NULL without one."""
    stamp = F.regexp_extract(line, text.LOG_TIME_PATTERN, 1)
    plain = F.regexp_replace(F.regexp_replace(stamp, ",", "."), "T", " ")
    return F.when(stamp != "", F.try_to_timestamp(plain))


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines with their ``time`` and an ``ord`` that orders them: by time, then by file name
    and by position in the file. A line without a time of its own, as of a traceback, is ordered behind the
    last line of its file that has one; before the first such line, before all others.

    A file is looked through block by block, as Spark reads it; what a block needs from before is one time.
    """
    block = ["_file", "_block"]
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_n"),
        line_time(F.col("value")).alias("time"),
        F.col("value").alias("line"),
    )
    upto = Window.partitionBy(*block).orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = rows.groupBy(*block).agg(F.max_by("time", F.when(F.col("time").isNotNull(), F.col("_n"))).alias("_end"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*block, F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    placed = rows.withColumn("_own", F.last("time", ignorenulls=True).over(upto)).join(ends, block)
    at = F.coalesce("_own", "_carried").alias("time")
    return placed.select(
        F.struct(at, F.struct(*block, "_n").alias("place")).alias("ord"), "time", "line"
    ).where(F.trim("line") != "")


def between(lines: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """Lines from ``since`` on and before ``until`` (UTC times as text); a limit drops lines without a
    time."""
    out = lines
    if since is not None:
        out = out.where(F.col("time") >= F.lit(since).cast("timestamp"))
    if until is not None:
        out = out.where(F.col("time") < F.lit(until).cast("timestamp"))
    return out


def stream_logs(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return lines.select(F.col("value").alias("line")).where(F.trim("line") != "")


def matching(lines: DataFrame, pattern: str, *, ignore_case: bool = True) -> DataFrame:
    return lines.where(F.col("line").rlike(("(?i)" if ignore_case else "") + pattern))


def service_log(lines: DataFrame, *, ops: bool = False) -> DataFrame:
    return matching(lines, text.OPS_LOG_PATTERN if ops else text.CORE_LOG_PATTERN)


def shown_log(lines: DataFrame) -> DataFrame:
    """Lines offered to a chat: noteworthy ones only, trimmed, secrets masked."""
    picked = matching(lines, text.CHAT_LOG_PATTERN)
    return picked.withColumn("line", text.redact(F.trim("line"))).where(F.trim("line") != "")


def last_lines(lines: DataFrame) -> DataFrame:
    """The newest line of each kind; a NULL where none matches."""
    line = F.col("line")
    wanted = {
        "last_health": line.contains(text.HEALTH_LINE_TEXT),
        "last_alert": line.rlike(text.ALERT_LINE_PATTERN),
        "last_schema": line.contains(text.STARTED_LINE_TEXT) & line.contains(text.SCHEMA_LINE_TEXT),
        "last_health_sent": line.contains(text.HEALTH_SENT_TEXT),
        "last_warning_sent": line.rlike(text.WARNING_SENT_PATTERN),
    }
    return lines.agg(
        *[F.max_by("line", F.when(cond, F.col("ord"))).alias(name) for name, cond in wanted.items()]
    )
