"""The commands over a stored table, each as a user would call it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..schema import GAPS
from ..session import shared_folder
from ..sources import derived
from . import commands
from . import sqltext as q
from .catalog import CHECKS, query
from .ingest_queries import _gaps, _loaded_store
from .quality_queries import NOW, P, _asked_days
from .scalar_queries import OPS, STAMPED_SQL, _read_back


def _store(spark, sf_dir):
    store = _loaded_store(spark, sf_dir)
    store.append_gaps(_gaps(spark, sf_dir))
    return store


def _asked(spark, sf_dir) -> list[str]:
    return sorted(r[0] for r in _asked_days(spark, sf_dir).collect())  # names of days


@query("cmd_status", CHECKS["j5_status"].replace("rank <= 3", "rank <= 20").replace("SELECT dt.*,", "SELECT dt.*, TRUE AS on_disk,"))
def cmd_status(spark, sf_dir):
    """``status``: each day's figures, its busiest symbols and its size on disk."""
    store = _store(spark, sf_dir)
    path = shared_folder(spark, "logs")
    spark.createDataFrame([("2024-01-01 00:00:00 health sid=1",)], "value string").write.text(path)
    rows = commands.service_status(store, NOW, path)
    shown = quality.status(store.ticks(), store.gaps(), NOW).columns
    return rows.select(*shown, (F.col("bytes") > 0).alias("on_disk"))


@query("cmd_validate", CHECKS["j3_validate_strict"])
def cmd_validate(spark, sf_dir):
    """``validate --strict`` of the stored days and of days that are not there."""
    out = commands.validate(_store(spark, sf_dir), _asked(spark, sf_dir), NOW, strict=True)
    return out.withColumns({c: F.concat_ws(",", F.col(c)) for c in ("reasons", "warnings")})


@query(
    "cmd_logs",
    q.w(STAMPED_SQL)
    + f"""SELECT line FROM stamped WHERE regexp_matches(line, '(?i){OPS}')
  AND substr(line, 1, 19) >= '2023-11-14 22:20:00'""",
)
def cmd_logs(spark, sf_dir):
    """``logs --ops --since``."""
    path = shared_folder(spark, "logs")
    _read_back(spark, sf_dir).select("line").write.text(path)
    return commands.logs(spark, path, ops=True, since="2023-11-14 22:20:00").select("line")


@query("cmd_export_gaps", CHECKS["a8_gaps_csv"])
def cmd_export_gaps(spark, sf_dir):
    """``export gaps`` of all days, read back."""
    path = shared_folder(spark, "gaps-csv")
    commands.export_gaps(_store(spark, sf_dir), path)
    found = spark.read.schema(GAPS).option("header", True).option("escape", '"').csv(path)
    return found.drop("meta_json")


@query("cmd_export_report", CHECKS["a7_report_json"])
def cmd_export_report(spark, sf_dir):
    """``export report`` of the stored days, read back."""
    store, path = _store(spark, sf_dir), shared_folder(spark, "reports")
    days = sorted(r[0] for r in store.ticks().select("trading_day").distinct().collect())
    commands.export_report(store, days, P, NOW, path)
    schema = quality.nested_report(commands.report(store, days, P, NOW)).schema
    return spark.read.schema(schema).json(path).select(
        "trading_day", F.col("trading_day_dashed").alias("day_dashed"), "coverage.*",
        "volume.total_rows", "gaps.hard_gaps_total", "gaps.hard_gaps_total_sec",
        "gaps.largest_gap_sec", "observations.soft_stalls_total",
        "observations.soft_stalls_total_sec", "observations.largest_stall_sec",
        "conclusion.quality_grade",
    )


@query(
    "cmd_archive",
    q.w(q.EV)
    + """, d AS (SELECT trading_day, count(*) AS ticks_count, max(ts_ms) AS max_ts_ms,
  row_number() OVER (ORDER BY trading_day DESC) AS rn FROM ev GROUP BY 1)
SELECT trading_day, ticks_count, max_ts_ms, TRUE AS verify_ok, rn > 14 AS may_go FROM d""",
)
def cmd_archive(spark, sf_dir):
    """``archive``: the manifest, and which days may be retired."""
    store = _store(spark, sf_dir)
    manifest, expired = commands.archive(store, shared_folder(spark, "archive"), P, NOW)
    gone = expired.select("trading_day", F.lit(True).alias("may_go"))
    return manifest.join(gone, "trading_day", "left").select(
        "trading_day", "ticks_count", "max_ts_ms", "verify_ok", F.coalesce("may_go", F.lit(False)).alias("may_go")
    )


@query(
    "cmd_db_stats",
    q.w(q.EV) + "SELECT trading_day, count(*) AS rows, max(ts_ms) AS max_ts_ms, TRUE AS on_disk FROM ev GROUP BY 1",
)
def cmd_db_stats(spark, sf_dir):
    """``db stats``: rows, newest time and size of each day."""
    on_disk = ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("on_disk")
    return commands.db_stats(_store(spark, sf_dir)).select("trading_day", "rows", "max_ts_ms", on_disk)


@query(
    "cmd_db_symbol",
    q.w(q.EV)
    + f"""SELECT symbol, {q.clock("ts_ms")} AS local_time, price, volume, turnover, seq FROM ev
WHERE symbol = 'HK.purchase' ORDER BY ts_ms DESC, seq DESC NULLS LAST LIMIT 20""",
)
def cmd_db_symbol(spark, sf_dir):
    """``db symbol``: the newest ticks of one symbol."""
    return commands.db_symbol(_store(spark, sf_dir).ticks(), "HK.purchase")


@query("cmd_db_top_symbols", CHECKS["e7_top_symbols_volume"].replace("rank <= 10", "rank <= 50"))
def cmd_db_top_symbols(spark, sf_dir):
    """``db top-symbols`` by volume over a table of many symbols, by day."""
    return commands.db_top_symbols(derived.lineitem_ticks(spark, sf_dir), minutes=240, metric="volume", limit=50)
