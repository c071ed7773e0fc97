"""Scalar rules, calendar and log filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock, text
from ..params import parse_sessions
from ..sources import calendar, derived, logs
from . import sqltext as q
from .catalog import query
from .ingest_queries import HOLIDAY_SQL, _holiday_lines

TS = "(epoch_us(ts) // 1000)"


def _events(spark, sf_dir):
    ev = derived.table(spark, sf_dir, "events")
    return ev.withColumn("ts_ms", F.unix_millis(F.col("ts").cast("timestamp")))


def _orders(spark, sf_dir):
    return derived.table(spark, sf_dir, "orders")


DAY_TEXT_SQL = """days AS (SELECT o_orderkey, CASE o_orderpriority
  WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN '2-HIGH' THEN '  ' || strftime(o_orderdate, '%Y%m%d') || ' '
  WHEN '3-MEDIUM' THEN year(o_orderdate) || '/' || month(o_orderdate) || '/' || day(o_orderdate)
  WHEN '5-LOW' THEN '   ' ELSE 'day ' || o_orderkey END AS v FROM orders)"""


def _day_texts(spark, sf_dir):
    stamp, prio = F.col("o_orderdate"), F.col("o_orderpriority")
    value = (
        F.when(prio == "1-URGENT", F.date_format(stamp, "yyyy-MM-dd"))
        .when(prio == "2-HIGH", F.format_string("  %s ", F.date_format(stamp, "yyyyMMdd")))
        .when(prio == "3-MEDIUM", F.date_format(stamp, "yyyy/M/d"))
        .when(prio == "5-LOW", "   ")
        .otherwise(F.format_string("day %d", "o_orderkey"))
    )
    return _orders(spark, sf_dir).select("o_orderkey", value.alias("v"))


@query(
    "b1_normalize_day",
    q.w(DAY_TEXT_SQL)
    + """SELECT o_orderkey, CASE WHEN trim(v) = '' THEN NULL
  WHEN regexp_matches(trim(v), '^[0-9]{8}$') THEN trim(v)
  WHEN contains(v, '-') THEN replace(trim(v), '-', '') ELSE replace(trim(v), '/', '') END AS day
FROM days""",
)
def b1_normalize_day(spark, sf_dir):
    return _day_texts(spark, sf_dir).select("o_orderkey", clock.normalize_day("v").alias("day"))


@query("b2_trading_day", f"SELECT event_id, {q.day(TS)} AS trading_day FROM events")
def b2_trading_day(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", clock.trading_day("ts_ms").alias("trading_day"))


def _parsed(spark, sf_dir, texts, *, is_number=False):
    """``texts`` maps an output name to (time text, day text) built from the local stamp."""
    ev = _events(spark, sf_dir)
    local = F.from_utc_timestamp(F.timestamp_millis("ts_ms"), "Asia/Hong_Kong")
    out = ev.select("event_id", "ts_ms", local.alias("local"))
    for name, (value, day) in texts.items():
        out = clock.with_time(
            out, name, value, day, F.col("ts_ms") + 1000, is_number=is_number
        )
    return out.select("event_id", *texts)


def _show(pattern):
    return F.date_format("local", pattern)


@query(
    "b3_parse_time_text",
    f"""SELECT event_id, {TS} AS slashed, {TS} AS clock_only, {TS} - {TS} % 1000 AS zoned,
  {TS} // 1000 * 1000 AS epoch_text, NULL::BIGINT AS broken FROM events""",
)
def b3_parse_time_text(spark, sf_dir):
    none = F.lit(None).cast("string")
    offset = F.concat(
        F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd HH:mm:ss"), F.lit("Z")
    )
    return _parsed(
        spark,
        sf_dir,
        {
            "slashed": (_show("yyyy/M/d H:m:s.SSS"), none),
            "clock_only": (_show("HH:mm:ss.SSS"), _show("yyyy-MM-dd")),
            "zoned": (offset, none),
            "epoch_text": (F.floor(F.col("ts_ms") / 1000).cast("string"), none),
            "broken": (_show("HH.mm.ss"), none),
        },
    )


@query(
    "b3_parse_time_number",
    f"""SELECT event_id, {TS} AS millis, {TS} // 1000 * 1000 AS seconds,
  {TS} - {TS} % 1000 AS clock_number,
  strftime({q.local(TS)}, '%Y%m%d%H%M%S')::BIGINT AS long_number FROM events""",
)
def b3_parse_time_number(spark, sf_dir):
    none = F.lit(None).cast("string")
    return _parsed(
        spark,
        sf_dir,
        {
            "millis": (F.col("ts_ms").cast("string"), none),
            "seconds": (F.floor(F.col("ts_ms") / 1000).cast("string"), none),
            "clock_number": (_show("HHmmss").cast("bigint").cast("string"), _show("yyyyMMdd")),
            "long_number": (_show("yyyyMMddHHmmss"), none),
        },
        is_number=True,
    )


@query(
    "b4_compact_time",
    f"""SELECT event_id, {TS} - {TS} % 1000 AS six, {TS} - {TS} % 1000 AS fourteen,
  {TS} - {TS} % 1000 AS short FROM events""",
)
def b4_compact_time(spark, sf_dir):
    none = F.lit(None).cast("string")
    short = F.regexp_replace(_show("HHmmss"), "^0+", "")
    return _parsed(
        spark,
        sf_dir,
        {
            "six": (_show("HHmmss"), _show("yyyy/MM/dd")),
            "fourteen": (_show("yyyyMMddHHmmss"), none),
            "short": (F.when(short == "", "0").otherwise(short), _show("yyyyMMdd")),
        },
    )


@query(
    "b5_datetime_text",
    f"""SELECT event_id, {TS} AS dashed, {TS} - {TS} % 1000 AS with_t, {TS} - {TS} % 60000 AS minutes,
  {TS} AS offset_text FROM events""",
)
def b5_datetime_text(spark, sf_dir):
    none = F.lit(None).cast("string")
    elsewhere = F.from_utc_timestamp(F.timestamp_millis("ts_ms"), "+05:30")
    shifted = F.concat(F.date_format(elsewhere, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0530"))
    return _parsed(
        spark,
        sf_dir,
        {
            "dashed": (_show("yyyy-MM-dd HH:mm:ss.SSSSSS"), none),
            "with_t": (_show("yyyy-MM-dd'T'HH:mm:ss"), none),
            "minutes": (_show("yyyy-MM-dd HH:mm"), none),
            "offset_text": (shifted, none),
        },
    )


@query(
    "b6_local_to_utc",
    "SELECT o_orderkey, epoch_us(o_orderdate) // 1000 - 28800000 AS utc_ms FROM orders",
)
def b6_local_to_utc(spark, sf_dir):
    stamp = F.col("o_orderdate").cast("timestamp")
    return _orders(spark, sf_dir).select(
        "o_orderkey", clock.local_to_utc_ms(stamp).alias("utc_ms")
    )


SHIFT = "user_id * 240000"


@query(
    "b7_zone_shift_repair",
    f"""SELECT event_id, CASE WHEN {SHIFT} > 7200000 AND abs({SHIFT} - 28800000) <= 1800000
  THEN {TS} + {SHIFT} - 28800000 ELSE {TS} + {SHIFT} END AS repaired FROM events""",
)
def b7_zone_shift_repair(spark, sf_dir):
    """Stamps ahead of their receive time by four minutes per user number."""
    ahead = F.col("ts_ms") + F.col("user_id") * 240_000
    return _events(spark, sf_dir).select(
        "event_id", clock.repair_zone_shift(ahead, F.col("ts_ms")).alias("repaired")
    )


@query(
    "b8_market_of_symbol",
    """SELECT url, CASE WHEN contains(url, '.') THEN split_part(url, '.', 1) ELSE 'HK' END AS market
FROM pages""",
)
def b8_market_of_symbol(spark, sf_dir):
    return derived.table(spark, sf_dir, "pages").select("url", text.market_of("url").alias("market"))


@query(
    "b9_alias_choice",
    """SELECT event_id, CASE WHEN user_id % 3 = 0 THEN event_type ELSE 'v' || user_id END AS code,
  CASE WHEN event_id % 2 = 0 THEN user_id ELSE event_id END AS seq FROM events""",
)
def b9_alias_choice(spark, sf_dir):
    """An empty text and a zero fall through to the next alias."""
    code = F.when(F.col("user_id") % 3 == 0, "").otherwise(F.format_string("v%d", "user_id"))
    first = F.when(F.col("event_id") % 2 == 0, F.lit(0)).otherwise(F.col("event_id"))
    return _events(spark, sf_dir).select(
        "event_id",
        text.first_set(code, F.col("event_type")).alias("code"),
        text.first_set(first, F.col("user_id"), numeric=True).alias("seq"),
    )


@query(
    "b10_lenient_casts",
    """SELECT event_id, CASE WHEN user_id % 4 = 0 THEN user_id END AS whole,
  trunc(value)::BIGINT AS truncated, value AS number,
  nullif(trim(CASE WHEN user_id % 5 = 0 THEN '  ' ELSE ' ' || event_type || ' ' END), '') AS label
FROM events""",
)
def b10_lenient_casts(spark, sf_dir):
    whole = (
        F.when(F.col("user_id") % 4 == 0, F.format_string(" %d ", "user_id"))
        .when(F.col("user_id") % 4 == 1, F.format_string("%d.0", "user_id"))
        .otherwise("x")
    )
    label = F.when(F.col("user_id") % 5 == 0, "  ").otherwise(
        F.format_string(" %s ", "event_type")
    )
    return _events(spark, sf_dir).select(
        "event_id",
        text.to_long(whole).alias("whole"),
        text.to_long("value").alias("truncated"),
        text.to_float(F.col("value").cast("string")).alias("number"),
        text.clean_text(label).alias("label"),
    )


@query(
    "b11_local_text",
    f"""SELECT event_id, CASE WHEN user_id = 1 THEN 'n/a' ELSE {q.clock(TS)} END AS shown
FROM events""",
)
def b11_local_text(spark, sf_dir):
    known = F.when(F.col("user_id") != 1, F.col("ts_ms"))
    return _events(spark, sf_dir).select("event_id", clock.local_text(known).alias("shown"))


@query(
    "b12_dashed_day",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
)
def b12_dashed_day(spark, sf_dir):
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    return _orders(spark, sf_dir).select("o_orderkey", clock.dashed_day(compact).alias("day"))


@query(
    "b13_session_index",
    f"SELECT event_id, ({q.session(TS)})::INTEGER AS session FROM events",
)
def b13_session_index(spark, sf_dir):
    sessions = parse_sessions("09:30-12:00,13:00-16:00")
    return _events(spark, sf_dir).select(
        "event_id", clock.session_index("ts_ms", sessions).alias("session")
    )


@query(
    "b14_other_sessions",
    f"""SELECT event_id, (CASE WHEN isodow({q.local(TS)}) >= 6 THEN NULL
  WHEN {q.msod(TS)} < 28800000 THEN 0
  WHEN {q.msod(TS)} >= 72000000 AND {q.msod(TS)} < 86340000 THEN 1 END)::INTEGER AS session
FROM events""",
)
def b14_other_sessions(spark, sf_dir):
    """Sessions parsed from another specification."""
    sessions = parse_sessions("00:00-08:00, 20:00-23:59")
    return _events(spark, sf_dir).select(
        "event_id", clock.session_index("ts_ms", sessions).alias("session")
    )


MD_HOLIDAYS = """, hd AS (SELECT DISTINCT '2024' || substr(trading_day, 5) AS trading_day
  FROM holidays WHERE right(trading_day, 1) = '5')"""


@query(
    "b15_market_state",
    q.w(HOLIDAY_SQL)
    + MD_HOLIDAYS
    + f""", e AS (SELECT event_id, {TS} AS t, {q.day(TS)} AS market_day FROM events),
m AS (SELECT e.*, hd.trading_day IS NOT NULL AS h FROM e LEFT JOIN hd ON e.market_day = hd.trading_day)
SELECT event_id, market_day, {q.phase("t", "h")} AS market_mode,
  isodow({q.local("t")}) < 6 AND NOT h AS is_trading_day,
  ({q.phase("t", "h")}) = 'open' AS is_trading_session FROM m""",
)
def b15_market_state(spark, sf_dir):
    """With holidays on the days of the order list that end in 5, moved to 2024."""
    listed = calendar.parse_holidays(_holiday_lines(spark, sf_dir))
    moved = listed.where(F.col("trading_day").endswith("5")).select(
        F.concat(F.lit("2024"), F.substr("trading_day", F.lit(5))).alias("trading_day")
    )
    out = calendar.with_market_state(
        _events(spark, sf_dir).select("event_id", "ts_ms"), "ts_ms", moved.distinct()
    )
    return out.drop("ts_ms")


@query(
    "b22_open_close_distance",
    f"""SELECT event_id, greatest(0, (34200000 - {q.msod(TS)}) // 1000)::BIGINT AS to_open,
  greatest(0, ({q.msod(TS)} - 57600000) // 1000)::BIGINT AS since_close FROM events""",
)
def b22_open_close_distance(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id",
        clock.seconds_to_open("ts_ms").alias("to_open"),
        clock.seconds_since_close("ts_ms").alias("since_close"),
    )


LOG_SQL = """logs AS (SELECT event_id AS ord, CASE event_type
  WHEN 'view' THEN 'INFO health sid=s' || event_id || ' queue=' || user_id || '/500 drift_sec='
    || CAST(value AS DECIMAL(12, 2)) || ' persisted_per_min=' || user_id * 3
  WHEN 'click' THEN 'info persist_summary lag=' || CAST(value AS DECIMAL(12, 2)) || ' write=' || user_id
  WHEN 'error' THEN 'ERROR send failed token = abc' || event_id || ' via 12345678' || user_id
    || ':ABCDEFGHIJ_KLMNOPQRST-' || event_id
  WHEN 'purchase' THEN 'WARNING alert_event code=PERSIST_STALL eid=e' || event_id || ' severity=WARN'
  ELSE 'debug idle tick ' || event_id END AS line FROM events)"""


@query(
    "b18_kpi_extraction",
    q.w(LOG_SQL)
    + r"""SELECT ord, coalesce(nullif(regexp_extract(line, '(lag|lag_sec|drift|drift_sec)[=:]([0-9.]+)', 2), '')
  || 's', 'n/a') AS lag, coalesce(nullif(regexp_extract(line,
  '(persisted_per_min|persisted|min|write|write_per_min)[=:]([0-9.]+)', 2), '') || '/min', 'n/a')
  AS persisted, coalesce(nullif(regexp_extract(line, 'queue[=:]([0-9]+/[0-9]+)', 1), ''), 'n/a')
  AS queue FROM logs""",
)
def b18_kpi_extraction(spark, sf_dir):
    return derived.log_lines(spark, sf_dir).select(
        "ord",
        text.kpi_lag("line").alias("lag"),
        text.kpi_persisted("line").alias("persisted"),
        text.kpi_queue("line").alias("queue"),
    )


# fixed values: the patterns of functions/text.py, said again for the check
REDACT_SQL = (
    r"regexp_replace(regexp_replace(%s, '\b\d{8,}:[A-Za-z0-9_-]{20,}\b', '[REDACTED_TOKEN]', 'g'), "
    r"'(?i)token\s*[=:]\s*\S+', 'token=[REDACTED]', 'g')"
)


@query(
    "b19_redact_logs",
    q.w(LOG_SQL) + f"SELECT ord, {REDACT_SQL % 'line'} AS line FROM logs",
)
def b19_redact_logs(spark, sf_dir):
    return derived.log_lines(spark, sf_dir).select("ord", text.redact("line").alias("line"))


@query(
    "b19_redact_documents",
    f"SELECT doc_id, {REDACT_SQL % 'text'} AS text FROM documents",
)
def b19_redact_documents(spark, sf_dir):
    """Whole document texts with secrets masked."""
    docs = derived.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.redact("text").alias("text"))


@query(
    "b20_severity_rank",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 2 WHEN 'click' THEN 1 ELSE 0 END AS rank
FROM events""",
)
def b20_severity_rank(spark, sf_dir):
    name = (
        F.when(F.col("event_type") == "error", " alert ")
        .when(F.col("event_type") == "click", "Warn")
        .otherwise(F.col("event_type"))
    )
    return _events(spark, sf_dir).select("event_id", text.severity_rank(name).alias("rank"))


@query(
    "b21_ratios",
    """SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 0.0 ELSE
  round(event_id / (user_id % 10) * 100.0, 6) END::DOUBLE AS queue_pct,
  round(least(999.0, greatest(0, event_id - 50) / greatest(1, greatest(0, user_id - 20) +
    greatest(0, user_id - 100)) * 100.0), 6)::DOUBLE AS efficiency_pct FROM events""",
)
def b21_ratios(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id",
        F.round(text.queue_utilisation_pct("event_id", F.col("user_id") % 10), 6).alias(
            "queue_pct"
        ),
        F.round(
            text.write_efficiency_pct(
                F.col("event_id") - 50, F.col("user_id") - 20, F.col("user_id") - 100
            ),
            6,
        ).alias("efficiency_pct"),
    )


def _read_back(spark, sf_dir):
    """Stamped lines written to several files of different sizes and read by the log source."""
    from ..session import shared_folder

    path = shared_folder(spark, "logs")
    lines = derived.log_lines(spark, sf_dir)
    stamp = F.date_format(F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("ord") * 1000), "yyyy-MM-dd HH:mm:ss")
    stamped = lines.select("ord", F.concat(stamp, F.lit(" "), "line").alias("line"))
    newest = F.col("ord") % 10
    for part, rows in enumerate((stamped.where(newest < 7), stamped.where(newest >= 7))):
        rows.select("line").repartition(2, "line").write.mode("append").text(f"{path}/{part}")
    return logs.read_logs(spark, f"{path}/*")


STAMPED_SQL = LOG_SQL.rstrip() + """,
stamped AS (SELECT ord, strftime(make_timestamp((1700000000000 + ord * 1000) * 1000), '%Y-%m-%d %H:%M:%S')
  || ' ' || line AS line FROM logs)"""


@query(
    "a17_log_source",
    q.w(STAMPED_SQL) + "SELECT line, substr(line, 1, 19) AS stamp FROM stamped",
)
def a17_log_source(spark, sf_dir):
    """Lines of several files with the time that orders them."""
    stamp = F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("stamp")
    return _read_back(spark, sf_dir).select("line", stamp)


@query(
    "a17_log_since",
    q.w(STAMPED_SQL)
    + """SELECT line FROM stamped WHERE substr(line, 1, 19) >= '2023-11-14 22:20:00'
  AND substr(line, 1, 19) < '2023-11-14 22:28:20'""",
)
def a17_log_since(spark, sf_dir):
    lines = _read_back(spark, sf_dir)
    return logs.between(lines, "2023-11-14 22:20:00", "2023-11-14 22:28:20").select("line")


# fixed values: the log filter
OPS = "health|health_symbols_rollup|persist_summary|WATCHDOG|ERROR|Traceback|telegram_|sqlite_busy|poll_stats|persist_ticks"  # noqa: E501


@query(
    "c7_ops_log_lines",
    q.w(LOG_SQL) + f"SELECT ord, line FROM logs WHERE regexp_matches(line, '(?i){OPS}')",
)
def c7_ops_log_lines(spark, sf_dir):
    return logs.service_log(derived.log_lines(spark, sf_dir), ops=True)


@query(
    "c7_chat_log_lines",
    q.w(LOG_SQL)
    + f"""SELECT ord, {REDACT_SQL % 'trim(line)'} AS line FROM logs
WHERE regexp_matches(line, '(?i)(ERROR|WARN|WATCHDOG|persist|sqlite_busy|alert_event)')""",
)
def c7_chat_log_lines(spark, sf_dir):
    return logs.shown_log(derived.log_lines(spark, sf_dir))


@query(
    "c7_last_lines",
    q.w(STAMPED_SQL)
    + """SELECT (SELECT max_by(line, ord) FROM stamped WHERE contains(line, 'health sid=')) AS last_health,
  (SELECT max_by(line, ord) FROM stamped
    WHERE regexp_matches(line, 'severity=(WARN|ALERT)|WATCHDOG|alert_event code=')) AS last_alert,
  (SELECT max_by(line, ord) FROM stamped WHERE contains(line, 'telegram_notifier_started')
    AND contains(line, 'notify_schema=')) AS last_schema,
  (SELECT max_by(line, ord) FROM stamped WHERE contains(line, 'telegram_enqueue kind=HEALTH'))
    AS last_health_sent,
  (SELECT max_by(line, ord) FROM stamped
    WHERE regexp_matches(line, 'telegram_enqueue kind=.* severity=(WARN|ALERT)')) AS last_warning_sent""",
)
def c7_last_lines(spark, sf_dir):
    return logs.last_lines(_read_back(spark, sf_dir))
