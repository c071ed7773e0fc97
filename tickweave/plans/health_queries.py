"""Health snapshots, alert decisions, stalls, digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import folds, health
from ..sources import derived
from . import sqltext as q
from .catalog import query

P = derived.SPARSE_HEALTH

H = f"""h0 AS (
SELECT *, epoch_us(ts) // 1000 AS ts_ms, 'node' || user_id % 5 AS instance, 'HK.' || event_type AS symbol,
  epoch_us(ts) // 1000 // 3600000 * 3600000 + 3600000 AS created_at_ms FROM events),
hs AS (
SELECT instance, created_at_ms, symbol, count(*) AS n, max(ts_ms) AS last_ts, max(event_id) AS last_seq,
  (sum(user_id) % 50 - 10)::BIGINT AS lag,
  CASE WHEN symbol <> 'HK.signup' THEN (created_at_ms - max(ts_ms)) / 1000.0::DOUBLE END AS age
FROM h0 GROUP BY 1, 2, 3),
hv AS (
SELECT instance, created_at_ms, count(*) AS poll_fetched, max(value) - 100 AS drift_sec,
  count(*) FILTER (value > 150) * 40 AS queue_size, count(*) FILTER (value > 60) * 10 AS persisted,
  count(*) FILTER (value > 80) AS push, count(*) FILTER (value > 100) AS accepted,
  count(*) FILTER (value > 120) AS queue_out, count(*) FILTER (event_type = 'error') AS dups,
  count(*) FILTER (event_type = 'view') AS views FROM h0 GROUP BY 1, 2),
ha AS (
SELECT instance, created_at_ms, max(age) AS max_age_sec, greatest(0, max(lag)) AS max_lag,
  list_sort(list(age) FILTER (age IS NOT NULL)) AS ages FROM hs GROUP BY 1, 2),
h AS (
SELECT hv.*, max_age_sec, max_lag, ages,
  ages[1 + floor((len(ages) - 1) * 0.5)::INTEGER] AS age_p50,
  ages[1 + floor((len(ages) - 1) * 0.95::DOUBLE)::INTEGER] AS age_p95,
  instance || '-' || created_at_ms AS sid, {q.day("created_at_ms")} AS trading_day,
  (created_at_ms - 1704067200000) // 3600000 * 100 + poll_fetched AS db_rows,
  {q.phase("created_at_ms")} AS phase, queue_size / 100 * 100.0 AS queue_pct
FROM hv JOIN ha USING (instance, created_at_ms))"""

RUNS = """hq AS (
SELECT *, coalesce(phase = 'open' AND persisted = 0 AND push = 0 AND accepted = 0 AND queue_size = 0
  AND age_p50 >= 600 AND age_p95 >= 900, FALSE) AS quiet FROM h),
hi AS (SELECT *, sum((NOT quiet)::INTEGER) OVER (PARTITION BY instance ORDER BY created_at_ms) AS grp
  FROM hq),
runs AS (SELECT *, CASE WHEN quiet THEN count(*) FILTER (quiet) OVER (PARTITION BY instance, grp
  ORDER BY created_at_ms) ELSE 0 END AS quiet_run,
  lag(persisted) OVER (PARTITION BY instance ORDER BY created_at_ms) AS prev_persisted FROM hi)"""

ASSESS = """a0 AS (
SELECT *, CASE WHEN phase = 'open' AND quiet_run >= 3 THEN 'holiday-closed' ELSE phase END AS mode,
  coalesce(prev_persisted > 0 AND persisted > 0
    AND persisted < greatest(1, floor(prev_persisted * 0.3)), FALSE) AS low_persist FROM runs),
assessed AS (
SELECT *, CASE
  WHEN mode = 'open' THEN CASE WHEN persisted = 0 AND (queue_size > 0 OR max_lag > 0) THEN 'write_stopped'
    WHEN abs(drift_sec) >= 120 OR queue_pct >= 60 OR low_persist THEN 'degraded' ELSE 'normal' END
  WHEN mode = 'pre-open' THEN CASE WHEN queue_pct >= 80 THEN 'queue_high' ELSE 'normal' END
  WHEN queue_size > 0 AND persisted <= 0 THEN 'backlog' ELSE 'normal' END AS finding FROM a0)"""


@query(
    "e11_stale_symbols",
    q.w(H)
    + """SELECT sid, len(list_filter(ages, lambda a: a >= CASE WHEN phase = 'open' THEN 10 ELSE 120 END))::INTEGER
  AS stale_symbols,
  len(list_filter(ages, lambda a: a >= CASE WHEN phase = 'open' THEN 30 ELSE 300 END))::INTEGER
  AS stale_bucket_2,
  len(list_filter(ages, lambda a: a >= CASE WHEN phase = 'open' THEN 60 ELSE 900 END))::INTEGER
  AS stale_bucket_3 FROM h WHERE ages IS NOT NULL
UNION ALL SELECT sid, 0, 0, 0 FROM h WHERE ages IS NULL""",
)
def e11_stale_symbols(spark, sf_dir):
    out = health.stale_counts(derived.health(spark, sf_dir), P)
    return out.select("sid", "stale_symbols", "stale_bucket_2", "stale_bucket_3")


@query(
    "e12_top_stale",
    q.w(H)
    + """, v AS (SELECT instance, created_at_ms, 'age' AS kind, symbol, greatest(0, age) AS value FROM hs
  WHERE age IS NOT NULL UNION ALL
  SELECT instance, created_at_ms, 'lag', symbol, greatest(0, lag)::DOUBLE FROM hs)
SELECT instance, instance || '-' || created_at_ms AS sid, kind, symbol, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY instance, created_at_ms, kind ORDER BY value DESC, symbol)::INTEGER
  AS rank FROM v) WHERE rank <= 2""",
)
def e12_top_stale(spark, sf_dir):
    return health.top_stale(derived.health(spark, sf_dir), 2)


@query("e20_symbol_extremes", q.w(H) + "SELECT sid, max_age_sec, max_lag, age_p50, age_p95 FROM h")
def e20_symbol_extremes(spark, sf_dir):
    out = health.symbol_extremes(derived.health(spark, sf_dir))
    return out.select("sid", "max_age_sec", "max_lag", "age_p50", "age_p95")


@query(
    "e17_daily_digest",
    q.w(H)
    + """SELECT instance, trading_day, sum(persisted)::BIGINT AS total_rows, max(persisted) AS peak_rows_per_min,
  max(abs(drift_sec)) AS max_lag_sec, arg_min(db_rows, created_at_ms) AS start_db_rows,
  max(db_rows) AS db_rows, greatest(0, max(db_rows) - arg_min(db_rows, created_at_ms)) AS growth_rows
FROM h GROUP BY 1, 2""",
)
def e17_daily_digest(spark, sf_dir):
    return health.daily_digest(derived.health(spark, sf_dir))


ALERTS = f"""al AS (
SELECT epoch_us(ts) // 1000 AS created_at_ms, event_id AS ord,
  CASE WHEN value BETWEEN 20 AND 25 THEN 'resolve' ELSE 'alert' END AS kind, event_type AS code,
  event_type || ':' || user_id % 4 AS fingerprint, 'node' || user_id % 5 AS instance, {q.day("(epoch_us(ts) // 1000)")} AS trading_day,
  CASE WHEN value BETWEEN 20 AND 25 THEN 'OK' WHEN value > 100 THEN 'ALERT' WHEN value > 30 THEN 'WARN'
    ELSE 'OK' END AS severity FROM events)"""


@query(
    "e18_alert_counts",
    q.w(ALERTS)
    + """, c AS (SELECT trading_day, upper(code) AS code, count(*) AS n FROM al WHERE severity <> 'OK'
  GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trading_day ORDER BY n DESC, code)::INTEGER AS rank
  FROM c) WHERE rank <= 3""",
)
def e18_alert_counts(spark, sf_dir):
    return health.alert_counts(derived.alerts(spark, sf_dir), 3)


@query(
    "f7_counter_delta",
    q.w(H)
    + """, c AS (SELECT instance, created_at_ms, queue_size + poll_fetched AS busy FROM h),
d AS (SELECT *, greatest(0, busy - coalesce(lag(busy) OVER (PARTITION BY instance
  ORDER BY created_at_ms), 0)) AS delta FROM c)
SELECT instance, created_at_ms, delta, delta >= 3 AS alert FROM d""",
)
def f7_counter_delta(spark, sf_dir):
    counters = derived.health(spark, sf_dir).withColumn(
        "busy", F.col("queue_size") + F.col("poll_fetched")
    )
    out = health.counter_delta(counters, "busy")
    return out.select("instance", "created_at_ms", "delta", "alert")


@query(
    "f8_throughput_drop",
    q.w(H, RUNS, ASSESS) + "SELECT sid, low_persist FROM a0",
)
def f8_throughput_drop(spark, sf_dir):
    return health.throughput_drop(derived.health(spark, sf_dir)).select("sid", "low_persist")


def _crossed_sql(name: str, limit: int, absolute: bool) -> str:
    b = f"abs({name})" if absolute else name
    a = f"abs(p_{name})" if absolute else f"p_{name}"
    return (
        f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN ({a} < {limit} AND {b} >= {limit}) "
        f"OR ({a} >= {limit} AND {b} < {limit}) ELSE coalesce({b} >= {limit}, FALSE) END"
    )


@query(
    "f9_threshold_crossings",
    q.w(H)
    + f""", p AS (SELECT *, lag(queue_pct) OVER w AS p_queue_pct, lag(max_age_sec) OVER w AS p_max_age_sec,
  lag(persisted) OVER w AS p_persisted, lag(drift_sec) OVER w AS p_drift_sec FROM h
  WINDOW w AS (PARTITION BY instance ORDER BY created_at_ms))
SELECT sid, CASE WHEN p_persisted IS NULL THEN FALSE ELSE
  abs(queue_pct - p_queue_pct) >= 20 OR {_crossed_sql("max_age_sec", 60, False)}
  OR (persisted > 0) <> (p_persisted > 0) OR {_crossed_sql("drift_sec", 60, True)} END AS changed FROM p""",
)
def f9_threshold_crossings(spark, sf_dir):
    return health.threshold_crossings(derived.health(spark, sf_dir)).select("sid", "changed")


@query("f10_quiet_runs", q.w(H, RUNS) + "SELECT sid, phase, quiet_run FROM runs")
def f10_quiet_runs(spark, sf_dir):
    return health.quiet_runs(derived.health(spark, sf_dir), P).select("sid", "phase", "quiet_run")


@query(
    "f11_sequence_advance",
    """WITH f AS (SELECT event_type AS symbol, epoch_us(ts) // 1000 // 3600000 * 3600000 AS fetched_at_ms,
  max(user_id) AS max_seq FROM events GROUP BY 1, 2)
SELECT symbol, fetched_at_ms, max_seq, coalesce(max_seq > max(max_seq) OVER (PARTITION BY symbol
  ORDER BY fetched_at_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS advanced FROM f""",
)
def f11_sequence_advance(spark, sf_dir):
    """Hourly fetches with the highest user number standing in for the fetched seq."""
    ev = derived.table(spark, sf_dir, "events")
    hour = F.floor(F.unix_millis(F.col("ts").cast("timestamp")) / 3_600_000) * 3_600_000
    fetches = ev.groupBy(
        F.col("event_type").alias("symbol"), hour.cast("bigint").alias("fetched_at_ms")
    ).agg(F.max("user_id").alias("max_seq"))
    return health.sequence_advance(fetches)


ASSESSED_SQL = """SELECT sid, mode AS market_mode, finding, CASE WHEN finding = 'normal' THEN 'OK'
  ELSE 'WARN' END AS severity, finding <> 'normal' AS needs_action FROM assessed"""


def _assessed(spark, sf_dir):
    return health.assess_health(derived.health(spark, sf_dir), P)


@query("i10_health_assessment", q.w(H, RUNS, ASSESS) + ASSESSED_SQL)
def i10_health_assessment(spark, sf_dir):
    return _assessed(spark, sf_dir).select(
        "sid", "market_mode", "finding", "severity", "needs_action"
    )


STEPS = """CASE n.rank WHEN 2 THEN [0, 10800, 14400, 36000] WHEN 1 THEN [0, 21600, 36000]
  ELSE [0, 14400, 36000] END"""
COOL = "(CASE n.rank WHEN 2 THEN 10800 WHEN 1 THEN 21600 ELSE 14400 END * 1000)"

DEDUPE_SQL = (
    q.w(ALERTS).replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
    + f""",
num AS (SELECT *, CASE severity WHEN 'ALERT' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END AS rank,
  row_number() OVER (PARTITION BY instance, fingerprint ORDER BY created_at_ms, ord) AS i FROM al),
seed AS (SELECT DISTINCT instance, fingerprint, 0::BIGINT AS i, 0::BIGINT AS ord, FALSE AS open,
  0::BIGINT AS first, 0::BIGINT AS sent, 0 AS rank, 0 AS step, '' AS reason FROM al),
fold AS (
SELECT * FROM seed
UNION ALL
SELECT instance, fingerprint, i, ord, kind <> 'resolve',
  CASE WHEN reason = 'new' THEN created_at_ms ELSE first END,
  CASE WHEN reason = 'cooldown_active' THEN sent ELSE created_at_ms END,
  CASE WHEN reason IN ('new', 'severity_upgraded') THEN rank ELSE prank END,
  CASE WHEN reason = 'new' THEN 1 WHEN starts_with(reason, 'esc') THEN step + 1 ELSE step END, reason
FROM (
  SELECT n.instance, n.fingerprint, n.i, n.ord, n.kind, n.created_at_ms, n.rank, f.first, f.sent,
    f.rank AS prank, f.step,
    CASE WHEN n.kind = 'resolve' THEN 'state_recovered' WHEN NOT f.open THEN 'new'
      WHEN n.rank > f.rank THEN 'severity_upgraded'
      WHEN n.created_at_ms - f.sent < {COOL} THEN 'cooldown_active'
      WHEN f.step < len({STEPS}) AND n.created_at_ms - f.first >= ({STEPS})[f.step + 1] * 1000
        THEN 'escalation_step_' || ({STEPS})[f.step + 1] || 's'
      ELSE 'cooldown_elapsed' END AS reason
  FROM fold f JOIN num n ON n.instance = f.instance AND n.fingerprint = f.fingerprint
    AND n.i = f.i + 1))
"""
)


@query(
    "i8_alert_dedupe",
    DEDUPE_SQL
    + """SELECT fingerprint, ord, reason, reason <> 'cooldown_active' AS emitted FROM fold WHERE i > 0""",
)
def i8_alert_dedupe(spark, sf_dir):
    out = folds.alert_decisions(derived.alerts(spark, sf_dir), P)
    return out.select("fingerprint", "ord", "reason", "emitted")


@query(
    "i9_alert_recoveries",
    DEDUPE_SQL
    + """SELECT a.instance, trading_day, count(*) FILTER (a.kind = 'alert' AND reason <> 'cooldown_active'
    AND severity <> 'OK') AS alert_count,
  count(*) FILTER (a.kind = 'resolve') AS recovered_count
FROM fold JOIN al a USING (instance, fingerprint, ord) WHERE i > 0 GROUP BY 1, 2""",
)
def i9_alert_recoveries(spark, sf_dir):
    """Digest counts of sent alerts and recoveries, of each instance."""
    decided = folds.alert_decisions(derived.alerts(spark, sf_dir), P)
    digest = health.daily_digest(derived.health(spark, sf_dir), decided)
    return digest.select("instance", "trading_day", "alert_count", "recovered_count")


EMISSION_SQL = (
    q.w(H, RUNS, ASSESS).replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
    + """,
num AS (SELECT instance, created_at_ms, trading_day, mode,
  CASE WHEN finding = 'normal' THEN 'OK' ELSE 'WARN' END AS sev,
  trading_day || ':' || mode || ';' AS pk, mode <> 'open' AS once,
  row_number() OVER (PARTITION BY instance ORDER BY created_at_ms) AS i FROM assessed),
fold AS (
SELECT DISTINCT instance, 0::BIGINT AS i, 0::BIGINT AS tm, '' AS mode, '' AS sev, '' AS sent_once,
  NULL::BIGINT AS sent, '' AS reason, FALSE AS emitted FROM num
UNION ALL
SELECT instance, i, tm, mode, sev,
  CASE WHEN emitted AND sev = 'OK' AND once THEN sent_once || pk ELSE sent_once END,
  CASE WHEN emitted THEN tm ELSE sent END, reason, emitted
FROM (SELECT *, reason NOT IN ('preopen_once', 'lunch_once', 'after_hours_once', 'holiday_daily_once',
    'ok_cooldown', 'warn_cooldown') AS emitted FROM (
  SELECT n.instance, n.i, n.created_at_ms AS tm, n.mode, n.sev, n.pk, n.once, f.sent_once, f.sent,
    CASE WHEN n.sev = 'OK' AND n.once AND contains(f.sent_once, n.pk) THEN CASE n.mode
        WHEN 'pre-open' THEN 'preopen_once' WHEN 'lunch-break' THEN 'lunch_once'
        WHEN 'after-hours' THEN 'after_hours_once' ELSE 'holiday_daily_once' END
      WHEN f.sev = '' THEN 'bootstrap' WHEN f.mode <> n.mode THEN 'market_mode_changed'
      WHEN f.sev <> n.sev THEN 'state_changed'
      WHEN n.created_at_ms - f.sent >= 1000 * CASE WHEN n.sev = 'WARN' THEN 21600
        WHEN n.mode = 'open' THEN 7200 WHEN n.mode = 'pre-open' THEN 3600 ELSE 18000 END
        THEN lower(n.sev) || '_cadence'
      ELSE lower(n.sev) || '_cooldown' END AS reason
  FROM fold f JOIN num n ON n.instance = f.instance AND n.i = f.i + 1)))
"""
)


@query(
    "i11_health_emission",
    EMISSION_SQL
    + """SELECT instance, tm AS created_at_ms, reason, emitted FROM fold WHERE i > 0""",
)
def i11_health_emission(spark, sf_dir):
    out = folds.health_emissions(_assessed(spark, sf_dir), P)
    return out.select("instance", "created_at_ms", "reason", "emitted")


@query(
    "e17_digest_due",
    EMISSION_SQL
    + f"""SELECT instance, {q.day("tm")} AS trading_day, min(tm) AS due_at_ms FROM fold
WHERE i > 0 AND emitted AND sev = 'OK' AND mode = 'after-hours' AND isodow({q.local("tm")}) < 6
  AND {q.msod("tm")} >= 57600000 GROUP BY 1, 2""",
)
def e17_digest_due(spark, sf_dir):
    return health.digest_due(folds.health_emissions(_assessed(spark, sf_dir), P), P)


@query(
    "i12_admission",
    """WITH RECURSIVE num AS (SELECT event_type, event_id, epoch_us(ts) // 1000 AS tm,
  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events),
fold AS (
SELECT DISTINCT event_type, 0::BIGINT AS event_id, 0::BIGINT AS i, []::BIGINT[] AS hits, FALSE AS admitted
FROM num
UNION ALL
SELECT event_type, event_id, i, CASE WHEN len(live) < 3 THEN list_append(live, tm) ELSE live END,
  len(live) < 3
FROM (SELECT n.event_type, n.event_id, n.i, n.tm,
  list_filter(f.hits, lambda t: n.tm - t < 3600000) AS live
  FROM fold f JOIN num n ON n.event_type = f.event_type AND n.i = f.i + 1))
SELECT event_type, event_id, admitted FROM fold WHERE i > 0""",
)
def i12_admission(spark, sf_dir):
    """Three per hour and event type."""
    ev = derived.table(spark, sf_dir, "events").withColumn(
        "at", F.unix_millis(F.col("ts").cast("timestamp"))
    )
    requests = ev.select("event_type", "event_id", "at")
    out = folds.admissions(requests, ["event_type"], "at", 3, 3600, ["event_id"])
    return out.select("event_type", "event_id", "admitted")


@query(
    "i13_write_stalls",
    q.w(H)
    + """, m AS (SELECT instance, created_at_ms AS minute_ms, queue_size, persisted, queue_out, poll_fetched, views,
  greatest(accepted, push + accepted) AS enqueued, dups < 3 AS alive,
  max(CASE WHEN push > 0 THEN created_at_ms - 30000 END) OVER w AS upstream,
  coalesce(max(CASE WHEN persisted > 0 THEN created_at_ms - 5000 END) OVER w, 1704067200000) AS commit_at
  FROM h WINDOW w AS (PARTITION BY instance ORDER BY created_at_ms)),
s AS (SELECT *, (minute_ms - commit_at) / 1000.0::DOUBLE AS commit_age_sec,
  (queue_size >= 40 OR enqueued > 0)
  AND ((coalesce(minute_ms - upstream <= 1800000, FALSE)
    AND (enqueued > 0 OR (poll_fetched > 0 AND views > 0) OR queue_out > 0)) OR queue_size >= 40)
  AND ((persisted <= 0 AND (minute_ms - commit_at) / 1000.0 >= 7200) OR NOT alive) AS stalled FROM m)
SELECT instance, minute_ms, commit_age_sec, stalled, CASE WHEN stalled AND NOT alive THEN 'worker_dead'
  WHEN stalled THEN 'no_commit' END AS reason FROM s""",
)
def i13_write_stalls(spark, sf_dir):
    out = health.write_stalls(derived.ingest_metrics(spark, sf_dir), P)
    return out.select("instance", "minute_ms", "commit_age_sec", "stalled", "reason")


@query(
    "i14_counters_per_window",
    q.w(q.EV)
    + """SELECT recv_ts_ms // 60000 * 60000 AS minute_ms, push_type, count(*) AS rows,
  count(*) FILTER (outcome = 'kept') AS kept, count(*) FILTER (outcome = 'duplicate') AS duplicate,
  count(*) FILTER (outcome = 'filtered') AS filtered
FROM (SELECT *, CASE WHEN price IS NULL THEN 'filtered' WHEN seq IS NULL THEN 'duplicate' ELSE 'kept' END
  AS outcome FROM ev) GROUP BY 1, 2""",
)
def i14_counters_per_window(spark, sf_dir):
    """Outcome counters per minute; a new window starts from zero by itself."""
    from ..operators import stats

    outcome = (
        F.when(F.col("price").isNull(), "filtered")
        .when(F.col("seq").isNull(), "duplicate")
        .otherwise("kept")
    )
    ticks = derived.event_ticks(spark, sf_dir).withColumn("outcome", outcome)
    return stats.ingest_per_minute(ticks, "outcome")


@query(
    "i16_muted_health",
    q.w(H, RUNS, ASSESS)
    + """, m AS (SELECT instance, created_at_ms AS from_ms, created_at_ms + 4 * 3600000 AS until_ms FROM h
  WHERE push >= 3),
r AS (SELECT *, CASE WHEN queue_size >= 80 THEN 'ALERT' WHEN finding = 'normal' THEN 'OK' ELSE 'WARN' END
  AS sev FROM assessed)
SELECT sid, sev AS severity FROM r WHERE sev = 'ALERT' OR NOT EXISTS (SELECT 1 FROM m
  WHERE m.instance = r.instance AND r.created_at_ms >= m.from_ms AND r.created_at_ms < m.until_ms)""",
)
def i16_muted_health(spark, sf_dir):
    """A busy snapshot mutes its instance for four hours; a long queue counts as an alert here."""
    severity = F.when(F.col("queue_size") >= 80, "ALERT").otherwise(F.col("severity"))
    rows = _assessed(spark, sf_dir).withColumn("severity", severity)
    mutes = derived.health(spark, sf_dir).where("push_rows_per_min >= 3").select(
        "instance",
        F.col("created_at_ms").alias("from_ms"),
        (F.col("created_at_ms") + 4 * 3_600_000).alias("until_ms"),
    )
    return health.drop_muted(rows, mutes).select("sid", "severity")


@query(
    "b21_write_efficiency",
    q.w(H)
    + """SELECT sid, round(least(999.0, persisted / greatest(1, push + accepted) * 100.0), 6)::DOUBLE
  AS efficiency_pct, queue_pct::DOUBLE AS queue_pct FROM h""",
)
def b21_write_efficiency(spark, sf_dir):
    h = derived.health(spark, sf_dir)
    ratio = text.write_efficiency_pct(
        "persisted_rows_per_min", "push_rows_per_min", "poll_accepted"
    )
    return h.select(
        "sid",
        F.round(ratio, 6).alias("efficiency_pct"),
        text.queue_utilisation_pct("queue_size", "queue_maxsize").alias("queue_pct"),
    )
