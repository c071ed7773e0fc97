"""Gaps, stalls, reports and verdicts."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..operators import gaps, quality
from ..session import shared_folder
from ..sources import derived
from ..sources.store import TickStore
from . import sqltext as q
from .catalog import query

P = derived.SPARSE_QUALITY
NOW = derived.NOW_MS


def _ticks(spark, sf_dir):
    return derived.event_ticks(spark, sf_dir)


def _gaps(spark, sf_dir):
    return gaps.hard_gaps(_ticks(spark, sf_dir), P, NOW)


@query(
    "f1_previous_tick",
    q.w(q.EV, q.POINTS) + "SELECT symbol, trading_day, ts_ms, prev_ts_ms FROM pts",
)
def f1_previous_tick(spark, sf_dir):
    return gaps.previous_ticks(_ticks(spark, sf_dir), P).drop("active_count")


@query(
    "f1_previous_tick_in_day",
    q.w(q.LI.replace("li AS", "ev AS"), q.DAY_POINTS)
    + "SELECT symbol, trading_day, ts_ms, prev_ts_ms FROM dpts",
)
def f1_previous_tick_in_day(spark, sf_dir):
    ticks = derived.lineitem_ticks(spark, sf_dir)
    return gaps.previous_ticks(ticks, P, per_day=True).drop("active_count")


@query(
    "f2_activity_count",
    q.w(q.EV, q.POINTS) + "SELECT symbol, trading_day, ts_ms, active_count FROM pts",
)
def f2_activity_count(spark, sf_dir):
    return gaps.tick_points(_ticks(spark, sf_dir), P).drop("prev_ts_ms")


@query(
    "f3_hard_gaps",
    q.w(q.EV, q.POINTS, q.GAPS)
    + """SELECT trading_day, symbol, gap_start_ts_ms, gap_end_ts_ms, gap_sec::DOUBLE AS gap_sec,
  'hard_gap' AS reason FROM gaps""",
)
def f3_hard_gaps(spark, sf_dir):
    return _gaps(spark, sf_dir).drop("detected_at_ms", "meta_json")


LONG_GAPS = f"""SELECT symbol, prev_ts_ms AS gap_start_ts_ms, ts_ms AS gap_end_ts_ms FROM pts
WHERE prev_ts_ms IS NOT NULL AND ({q.session("prev_ts_ms")}) = ({q.session("ts_ms")})
  AND ts_ms - prev_ts_ms > 3600000"""


@query("f3_hard_gaps_single_tick", q.w(q.EV, q.POINTS) + LONG_GAPS)
def f3_hard_gaps_single_tick(spark, sf_dir):
    """With one tick enough for activity, silence beyond the window and over nights is reported."""
    found = gaps.hard_gaps(
        _ticks(spark, sf_dir), dataclasses.replace(P, active_min_ticks=1), NOW
    )
    return found.select("symbol", "gap_start_ts_ms", "gap_end_ts_ms")


@query(
    "b17_gap_evidence",
    q.w(q.EV, q.POINTS, q.GAPS)
    + f"""SELECT symbol, gap_start_ts_ms, '{{"prev_ts_ms":' || gap_start_ts_ms || ',"curr_ts_ms":'
  || gap_end_ts_ms || ',"gap_threshold_sec":3600.0,"active_window_sec":21600,"active_min_ticks":5,'
  || '"active_count":' || active_count || ',"session":"' ||
  CASE {q.session("gap_end_ts_ms")} WHEN 0 THEN '09:30-12:00' ELSE '13:00-16:00' END || '"}}'
  AS meta_json FROM gaps""",
)
def b17_gap_evidence(spark, sf_dir):
    return _gaps(spark, sf_dir).select("symbol", "gap_start_ts_ms", "meta_json")


@query(
    "c6_same_session",
    q.w(q.EV, q.POINTS)
    + f"""SELECT symbol, ts_ms, coalesce(({q.session("prev_ts_ms")}) = ({q.session("ts_ms")}), FALSE)
  AS same_session FROM pts""",
)
def c6_same_session(spark, sf_dir):
    points = gaps.previous_ticks(_ticks(spark, sf_dir), P)
    return points.select(
        "symbol", "ts_ms", gaps.same_session("prev_ts_ms", "ts_ms", P).alias("same_session")
    )


@query(
    "f4_soft_stalls",
    q.w(q.EV, q.DAY_POINTS, q.STALLS)
    + """SELECT trading_day, symbol, stall_start_ts_ms, stall_end_ts_ms,
  (delta_ms / 1000.0)::DOUBLE AS stall_sec FROM stalls""",
)
def f4_soft_stalls(spark, sf_dir):
    return gaps.soft_stalls(_ticks(spark, sf_dir), P).drop("delta_ms", "meta_json")


@query(
    "f5_live_stalls",
    q.w(q.EV, q.POINTS)
    + f"""SELECT trading_day, symbol, prev_ts_ms AS stall_start_ts_ms,
  (ts_ms - prev_ts_ms) / 1000.0::DOUBLE AS stall_sec FROM pts
WHERE active_count >= 5 AND ({q.session("prev_ts_ms")}) = ({q.session("ts_ms")})
  AND ts_ms - prev_ts_ms > 1800000 AND ts_ms - prev_ts_ms <= 3600000""",
)
def f5_live_stalls(spark, sf_dir):
    params = dataclasses.replace(P, stall_warn_sec=1800.0)
    return gaps.soft_stalls(_ticks(spark, sf_dir), params, live=True).select(
        "trading_day", "symbol", "stall_start_ts_ms", "stall_sec"
    )


GAP_TOTALS = """gt AS (SELECT trading_day, count(*) AS hard_gaps_total,
  (sum(gap_ms) / 1000.0)::DOUBLE AS hard_gaps_total_sec, (max(gap_ms) / 1000.0)::DOUBLE AS largest_gap_sec
  FROM gaps GROUP BY 1)"""
STALL_TOTALS = """st AS (SELECT trading_day, count(*) AS soft_stalls_total,
  (sum(delta_ms) / 1000.0)::DOUBLE AS soft_stalls_total_sec,
  (max(delta_ms) / 1000.0)::DOUBLE AS largest_stall_sec FROM stalls GROUP BY 1)"""


@query("e5_gap_totals", q.w(q.EV, q.POINTS, q.GAPS, GAP_TOTALS) + "SELECT * FROM gt")
def e5_gap_totals(spark, sf_dir):
    return gaps.gap_totals(_gaps(spark, sf_dir))


@query(
    "e6_gaps_by_symbol",
    q.w(q.EV, q.POINTS, q.GAPS)
    + """, s AS (SELECT trading_day, symbol, count(*) AS gaps, (sum(gap_ms) / 1000.0)::DOUBLE
  AS total_gap_sec, (max(gap_ms) / 1000.0)::DOUBLE AS largest_gap_sec FROM gaps GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trading_day ORDER BY gaps DESC, symbol)::INTEGER
  AS rank FROM s) WHERE rank <= 2""",
)
def e6_gaps_by_symbol(spark, sf_dir):
    return gaps.gaps_by_symbol(_gaps(spark, sf_dir), 2)


@query(
    "e8_stall_totals",
    q.w(q.EV, q.DAY_POINTS, q.STALLS, STALL_TOTALS) + "SELECT * FROM st",
)
def e8_stall_totals(spark, sf_dir):
    return gaps.stall_totals(gaps.soft_stalls(_ticks(spark, sf_dir), P))


@query(
    "g5_stalls_sorted",
    q.w(q.EV, q.DAY_POINTS, q.STALLS)
    + """SELECT trading_day, symbol, stall_start_ts_ms, rank FROM (SELECT *, row_number() OVER (
  PARTITION BY trading_day ORDER BY delta_ms DESC, symbol, stall_start_ts_ms)::INTEGER AS rank
  FROM stalls) WHERE rank <= 2""",
)
def g5_stalls_sorted(spark, sf_dir):
    top = gaps.top_stalls(gaps.soft_stalls(_ticks(spark, sf_dir), P), 2)
    return top.select("trading_day", "symbol", "stall_start_ts_ms", "rank")


DAY_TOTALS = f"""dt AS (SELECT trading_day, count(*) AS total_rows, min(ts_ms) AS start_ts_ms,
  max(ts_ms) AS end_ts_ms, round((max(ts_ms) - min(ts_ms)) / 1000.0, 3)::DOUBLE AS duration_sec,
  round(greatest(0.0, ({NOW} - max(ts_ms)) / 1000.0), 3)::DOUBLE AS last_tick_age_sec
  FROM ev GROUP BY 1)"""
REPORT_SQL = (
    q.w(q.EV, q.POINTS, q.GAPS, GAP_TOTALS, q.DAY_POINTS, q.STALLS, STALL_TOTALS, DAY_TOTALS)
    + f""", f AS (SELECT trading_day, total_rows, start_ts_ms, end_ts_ms, duration_sec, last_tick_age_sec,
  coalesce(hard_gaps_total, 0) AS hard_gaps_total,
  coalesce(hard_gaps_total_sec, 0.0) AS hard_gaps_total_sec,
  coalesce(largest_gap_sec, 0.0) AS largest_gap_sec,
  coalesce(soft_stalls_total, 0) AS soft_stalls_total,
  coalesce(soft_stalls_total_sec, 0.0) AS soft_stalls_total_sec,
  coalesce(largest_stall_sec, 0.0) AS largest_stall_sec
FROM dt LEFT JOIN gt USING (trading_day) LEFT JOIN st USING (trading_day))
SELECT *, substr(trading_day, 1, 4) || '-' || substr(trading_day, 5, 2) || '-' ||
  substr(trading_day, 7, 2) AS day_dashed, {q.clock("start_ts_ms")} AS start_local,
  {q.clock("end_ts_ms")} AS end_local,
  CASE WHEN total_rows <= 0 THEN 'D' WHEN largest_gap_sec > 120 OR hard_gaps_total_sec > 900 THEN 'D'
    WHEN largest_gap_sec > 60 OR hard_gaps_total_sec > 300 THEN 'C'
    WHEN hard_gaps_total_sec > 0 OR soft_stalls_total_sec > 120 THEN 'B' ELSE 'A' END AS quality_grade
FROM f"""
)


def _report(spark, sf_dir):
    return quality.daily_report(_ticks(spark, sf_dir), _gaps(spark, sf_dir), P, NOW)


@query("j1_daily_report", REPORT_SQL)
def j1_daily_report(spark, sf_dir):
    return _report(spark, sf_dir).drop(
        "rows_per_symbol", "gaps_by_symbol", "soft_stalls", "warnings", "suggestion",
        "generated_at_ms",
    )


@query(
    "a6_daily_quality_upsert",
    f"""SELECT trading_day, (1 + second::INTEGER)::BIGINT AS created_at_ms,
  CASE WHEN second THEN 'second' ELSE 'first' END AS host, total_rows, hard_gaps_total,
  round(largest_gap_sec, 3)::DOUBLE AS largest_gap_sec, quality_grade
FROM (SELECT *, hard_gaps_total > 0 AS second FROM ({REPORT_SQL}))""",
)
def a6_daily_quality_upsert(spark, sf_dir):
    """Report rows of all days written, then those of the days with gaps written again."""
    store = TickStore(spark, shared_folder(spark, "store"))
    report = _report(spark, sf_dir)
    store.upsert_daily_quality(quality.daily_quality_rows(report, 1, "first"))
    again = report.where("hard_gaps_total > 0")
    store.upsert_daily_quality(quality.daily_quality_rows(again, 2, "second"))
    body = "total_rows bigint, hard_gaps_total bigint, largest_gap_sec double, quality_grade string"
    rows = store.daily_quality().withColumn("_s", F.from_json("summary_json", body))
    rows = rows.select("trading_day", "created_at_ms", "host", "_s.*")
    return rows.withColumn("largest_gap_sec", F.round("largest_gap_sec", 3))


@query(
    "a7_report_json",
    REPORT_SQL,
)
def a7_report_json(spark, sf_dir):
    """The nested report written per day and read back."""
    path = shared_folder(spark, "reports")
    report = _report(spark, sf_dir)
    quality.write_reports(report, path)
    back = spark.read.schema(quality.nested_report(report).schema).json(path)
    return back.select(
        "trading_day", F.col("trading_day_dashed").alias("day_dashed"), "coverage.*",
        "volume.total_rows", "gaps.hard_gaps_total", "gaps.hard_gaps_total_sec",
        "gaps.largest_gap_sec", "observations.soft_stalls_total",
        "observations.soft_stalls_total_sec", "observations.largest_stall_sec",
        "conclusion.quality_grade",
    )


@query(
    "j1_report_top_lists",
    q.w(q.EV, q.POINTS, q.GAPS, q.DAY_POINTS, q.STALLS)
    + f""", s AS (SELECT trading_day, symbol, count(*) AS n, max(ts_ms) AS t FROM ev GROUP BY 1, 2),
g AS (SELECT trading_day, symbol, count(*) AS n, sum(gap_ms)::BIGINT AS t FROM gaps GROUP BY 1, 2)
SELECT trading_day, 'rows' AS list, symbol, n, {q.clock("t")} AS detail,
  row_number() OVER (PARTITION BY trading_day ORDER BY n DESC, symbol)::INTEGER AS rank FROM s
UNION ALL SELECT trading_day, 'gaps', symbol, n, (t / 1000.0)::DECIMAL(18, 3)::VARCHAR,
  row_number() OVER (PARTITION BY trading_day ORDER BY n DESC, symbol)::INTEGER FROM g
UNION ALL SELECT trading_day, 'stalls', symbol, delta_ms, {q.clock("stall_start_ts_ms")},
  row_number() OVER (PARTITION BY trading_day ORDER BY delta_ms DESC, symbol, stall_start_ts_ms)::INTEGER
  FROM stalls""",
)
def j1_report_top_lists(spark, sf_dir):
    """The three top lists of each day's report, flattened."""
    report = _report(spark, sf_dir)

    def flat(column, name, n, detail):
        rows = report.select("trading_day", F.inline(column))
        return rows.select(
            "trading_day", F.lit(name).alias("list"), "symbol", n.cast("bigint").alias("n"),
            detail.alias("detail"), "rank",
        )

    return (
        flat("rows_per_symbol", "rows", F.col("rows"), F.col("latest_local"))
        .unionByName(
            flat(
                "gaps_by_symbol",
                "gaps",
                F.col("gaps"),
                F.col("total_gap_sec").cast("decimal(18,3)").cast("string"),
            )
        )
        .unionByName(
            flat(
                "soft_stalls",
                "stalls",
                F.round(F.col("stall_sec") * 1000),
                F.col("stall_start_local"),
            )
        )
    )


@query(
    "j2_grade",
    q.w(q.LI)
    + """, d AS (SELECT trading_day, count(*) AS n, (sum(volume) % 1000)::DOUBLE AS total,
  (max(volume) * 3)::DOUBLE AS largest, (sum(volume) % 241)::DOUBLE AS stalls FROM li GROUP BY 1),
z AS (SELECT trading_day, n, CASE WHEN total < 400 THEN 0.0 ELSE total END AS total,
  CASE WHEN total < 400 THEN 0.0 ELSE largest END AS largest, stalls FROM d)
SELECT trading_day, CASE WHEN n <= 0 THEN 'D' WHEN largest > 120 OR total > 900 THEN 'D'
  WHEN largest > 60 OR total > 300 THEN 'C' WHEN total > 0 OR stalls > 120 THEN 'B' ELSE 'A' END
  AS quality_grade FROM z""",
)
def j2_grade(spark, sf_dir):
    """The grade over figures taken from the traded volumes of each lineitem day."""
    per_day = derived.lineitem_ticks(spark, sf_dir).groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("volume").alias("s"),
        F.max("volume").alias("m"),
    )
    quiet = F.col("s") % 1000 < 400
    zero = F.lit(0.0)
    total = F.when(quiet, zero).otherwise((F.col("s") % 1000).cast("double"))
    largest = F.when(quiet, zero).otherwise((F.col("m") * 3).cast("double"))
    stalls = (F.col("s") % 241).cast("double")
    return per_day.select(
        "trading_day", quality.grade(F.col("n"), total, largest, stalls).alias("quality_grade")
    )


def _asked_days(spark, sf_dir):
    """Days of the data plus the same days a month later, which have no data."""
    days = _ticks(spark, sf_dir).select("trading_day").distinct()
    absent = days.select(F.concat(F.lit("2025"), F.substr("trading_day", F.lit(5))))
    return days.union(absent).distinct()


def _validate_sql(now: int, strict: bool) -> str:
    gap = (
        "CASE WHEN r1 = '' AND (largest_gap_sec > 60 OR hard_gaps_total_sec > 300) "
        "THEN 'strict_mode_gap_threshold_exceeded' ELSE r1 END"
        if strict
        else "r1"
    )
    strict_warn = (
        "CASE WHEN r1 = '' AND NOT (largest_gap_sec > 60 OR hard_gaps_total_sec > 300) "
        "AND hard_gaps_total_sec > 0 THEN 'strict_mode_gap_observed' END"
        if strict
        else "NULL"
    )
    return (
        q.w(q.EV, q.POINTS, q.GAPS, GAP_TOTALS)
        + f""", asked AS (SELECT DISTINCT trading_day FROM ev
  UNION SELECT DISTINCT '2025' || substr(trading_day, 5) FROM ev),
d AS (SELECT trading_day, count(*) AS rows, max(ts_ms) AS max_ts_ms FROM ev GROUP BY 1),
f AS (SELECT trading_day, coalesce(rows, 0) AS rows, max_ts_ms,
  coalesce(largest_gap_sec, 0.0) AS largest_gap_sec,
  coalesce(hard_gaps_total_sec, 0.0) AS hard_gaps_total_sec,
  CASE WHEN rows IS NULL THEN 'db_not_found'
    WHEN max_ts_ms > {now} + 300000 THEN 'ticks_max_ts_too_far_in_future' ELSE '' END AS r1
  FROM asked LEFT JOIN d USING (trading_day) LEFT JOIN gt USING (trading_day)),
v AS (SELECT *, {gap} AS reasons, concat_ws(',',
  CASE WHEN max_ts_ms <= {now} + 300000 AND max_ts_ms > {now} + 60000
    THEN 'ticks_max_ts_slightly_in_future' END,
  CASE WHEN rows = 0 THEN 'quality_report_not_generated' END, {strict_warn}) AS warnings FROM f)
SELECT trading_day, CASE WHEN reasons <> '' THEN 'FAIL' WHEN warnings <> '' THEN 'WARN' ELSE 'PASS' END
  AS status, reasons, warnings, rows, max_ts_ms, largest_gap_sec, hard_gaps_total_sec FROM v"""
    )


def _validate(spark, sf_dir, now, strict):
    out = quality.validate(
        _asked_days(spark, sf_dir), _ticks(spark, sf_dir), _gaps(spark, sf_dir), now, strict=strict
    )
    return out.withColumns(
        {c: F.concat_ws(",", F.col(c)) for c in ("reasons", "warnings")}
    )


MID = 1_705_420_000_000  # a 'now' in the middle of the data, so later days lie in the future


@query("j3_validate", _validate_sql(MID, False))
def j3_validate(spark, sf_dir):
    return _validate(spark, sf_dir, MID, False)


@query("j3_validate_strict", _validate_sql(NOW, True))
def j3_validate_strict(spark, sf_dir):
    return _validate(spark, sf_dir, NOW, True)


@query(
    "j4_day_warnings",
    q.w(q.EV)
    + """SELECT DISTINCT trading_day, 'gaps_table_missing' AS warnings FROM ev
UNION ALL SELECT DISTINCT '2025' || substr(trading_day, 5), 'db_not_found' FROM ev""",
)
def j4_day_warnings(spark, sf_dir):
    flags = quality.day_warnings(
        _asked_days(spark, sf_dir), _ticks(spark, sf_dir), gaps_table=False
    )
    return flags.withColumn("warnings", F.concat_ws(",", "warnings"))


@query(
    "j5_status",
    q.w(q.EV, q.POINTS, q.GAPS, GAP_TOTALS, DAY_TOTALS)
    + f""", s AS (SELECT trading_day, symbol, count(*) AS rows, max(ts_ms) AS latest_ts_ms FROM ev
  GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY trading_day ORDER BY rows DESC, symbol)::INTEGER AS rank
  FROM s)
SELECT dt.*, coalesce(hard_gaps_total, 0) AS gaps_total, coalesce(largest_gap_sec, 0.0)
  AS largest_gap_sec, rank, symbol, rows, latest_ts_ms,
  round(greatest(0.0, ({NOW} - latest_ts_ms) / 1000.0), 3)::DOUBLE AS symbol_age_sec
FROM dt LEFT JOIN gt USING (trading_day) LEFT JOIN r ON r.trading_day = dt.trading_day AND rank <= 3
""",
)
def j5_status(spark, sf_dir):
    return quality.status(_ticks(spark, sf_dir), _gaps(spark, sf_dir), NOW, top_n=3)


