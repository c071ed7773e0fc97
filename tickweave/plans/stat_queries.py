"""Statistics, rankings, percentiles and top-k reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock, text
from ..operators import dedupe, stats
from ..sources import derived
from . import sqltext as q
from .catalog import query

NOW = derived.NOW_MS


def _ticks(spark, sf_dir):
    return derived.event_ticks(spark, sf_dir)


def _busy(spark, sf_dir):
    return derived.lineitem_ticks(spark, sf_dir)


def age(ts: str) -> str:
    return f"round(greatest(0.0, ({NOW} - {ts}) / 1000.0), 3)::DOUBLE"


@query(
    "e1_day_stats",
    q.w(q.LI)
    + """SELECT trading_day, count(*) AS total_rows, min(ts_ms) AS start_ts_ms,
  max(ts_ms) AS end_ts_ms FROM li GROUP BY 1""",
)
def e1_day_stats(spark, sf_dir):
    return stats.day_stats(_busy(spark, sf_dir))


@query(
    "e2_symbol_stats",
    q.w(q.LI)
    + """SELECT trading_day, symbol, count(*) AS rows, min(ts_ms) AS min_ts_ms,
  max(ts_ms) AS latest_ts_ms FROM li GROUP BY 1, 2""",
)
def e2_symbol_stats(spark, sf_dir):
    return stats.symbol_stats(_busy(spark, sf_dir))


@query(
    "c1_day_filter",
    q.w(q.EV) + "SELECT symbol, ts_ms, price FROM ev WHERE trading_day = '20240110'",
)
def c1_day_filter(spark, sf_dir):
    rows = _ticks(spark, sf_dir).where(F.col("trading_day") == "20240110")
    return rows.select("symbol", "ts_ms", "price")


@query(
    "c2_symbol_filter",
    q.w(q.EV) + "SELECT symbol, ts_ms, price, volume FROM ev WHERE symbol = 'HK.click'",
)
def c2_symbol_filter(spark, sf_dir):
    rows = _ticks(spark, sf_dir).where(F.col("symbol") == "HK.click")
    return rows.select("symbol", "ts_ms", "price", "volume")


@query(
    "c3_symbols_with_seq",
    q.w(q.EV)
    + """SELECT symbol, seq, ts_ms FROM ev
WHERE symbol IN ('HK.view', 'HK.error') AND seq IS NOT NULL""",
)
def c3_symbols_with_seq(spark, sf_dir):
    wanted = F.col("symbol").isin("HK.view", "HK.error") & F.col("seq").isNotNull()
    return _ticks(spark, sf_dir).where(wanted).select("symbol", "seq", "ts_ms")


@query(
    "c4_trailing_range",
    q.w(q.EV)
    + """SELECT trading_day, symbol, ts_ms, price FROM ev
JOIN (SELECT trading_day, max(ts_ms) - 14400000 AS cutoff FROM ev GROUP BY 1) USING (trading_day)
WHERE ts_ms >= cutoff""",
)
def c4_trailing_range(spark, sf_dir):
    rows = stats.trailing_window(_ticks(spark, sf_dir), 240)
    return rows.select("trading_day", "symbol", "ts_ms", "price")


@query(
    "e3_max_seq_one_day",
    q.w(q.EV)
    + """SELECT symbol, max(seq) AS max_seq FROM ev WHERE trading_day = '20240112'
  AND symbol IN ('HK.view', 'HK.click', 'HK.error') AND seq IS NOT NULL GROUP BY 1""",
)
def e3_max_seq_one_day(spark, sf_dir):
    day = _ticks(spark, sf_dir).where("trading_day = '20240112'")
    return dedupe.max_seq_by_symbol(day, ["HK.view", "HK.click", "HK.error"])


@query(
    "e4_max_seq_recent_days",
    q.w(q.EV)
    + """SELECT symbol, max(seq) AS max_seq FROM ev WHERE seq IS NOT NULL AND trading_day IN (
  SELECT DISTINCT trading_day FROM ev ORDER BY 1 DESC LIMIT 3) GROUP BY 1""",
)
def e4_max_seq_recent_days(spark, sf_dir):
    return stats.recent_max_seq(_ticks(spark, sf_dir), None, recent=3)


@query(
    "e4_max_seq_all_days",
    q.w(q.LI)
    + """SELECT symbol, max(seq) AS max_seq FROM li WHERE seq IS NOT NULL GROUP BY 1""",
)
def e4_max_seq_all_days(spark, sf_dir):
    """Over thousands of days, all of them asked for."""
    return stats.recent_max_seq(_busy(spark, sf_dir), None, recent=100_000)


@query(
    "e4_max_seq_given_days",
    q.w(q.EV)
    + """SELECT symbol, max(seq) AS max_seq FROM ev WHERE seq IS NOT NULL
  AND trading_day IN ('20240104', '20240103') GROUP BY 1""",
)
def e4_max_seq_given_days(spark, sf_dir):
    days = ["20240104", "2024-01-09", "20240103", " 20240104 "]
    return stats.recent_max_seq(_ticks(spark, sf_dir), None, days)


TOP_SQL = f"""agg AS (
SELECT trading_day, symbol, count(*) AS rows, round(coalesce(sum(turnover), 0.0), 3) AS turnover,
  coalesce(sum(volume), 0)::BIGINT AS volume, max(ts_ms) AS latest_ts_ms
FROM %(t)s JOIN (SELECT trading_day, max(ts_ms) - 14400000 AS cutoff FROM %(t)s GROUP BY 1)
  USING (trading_day) WHERE ts_ms >= cutoff GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY trading_day ORDER BY %(m)s DESC, symbol)::INTEGER
  AS rank FROM agg)
"""


def _top_sql(name: str, base: str, metric: str, limit: int) -> str:
    return q.w(base, TOP_SQL % {"t": name, "m": metric}) + f"SELECT * FROM ranked WHERE rank <= {limit}"


@query("e7_top_symbols_rows", _top_sql("ev", q.EV, "rows", 3))
def e7_top_symbols_rows(spark, sf_dir):
    """Through the command, which holds the minutes to 240."""
    from . import commands

    return commands.db_top_symbols(_ticks(spark, sf_dir), minutes=999, metric="rows", limit=3)


@query("e7_top_symbols_volume", _top_sql("li", q.LI, "volume", 10))
def e7_top_symbols_volume(spark, sf_dir):
    return stats.top_symbols(_busy(spark, sf_dir), minutes=240, metric="volume", limit=10)


@query("e7_top_symbols_turnover", _top_sql("li", q.LI, "turnover", 10))
def e7_top_symbols_turnover(spark, sf_dir):
    return stats.top_symbols(_busy(spark, sf_dir), minutes=240, metric="turnover", limit=10)


@query(
    "e7_top_symbols_one_day",
    _top_sql("ev", q.EV, "volume", 2) + " AND trading_day = '20240109'",
)
def e7_top_symbols_one_day(spark, sf_dir):
    return stats.top_symbols(
        _ticks(spark, sf_dir), minutes=240, metric="volume", limit=2, day="20240109"
    )


@query(
    "e9_coverage",
    q.w(q.LI)
    + f"""SELECT trading_day, count(*) AS total_rows, min(ts_ms) AS start_ts_ms,
  max(ts_ms) AS end_ts_ms, round((max(ts_ms) - min(ts_ms)) / 1000.0, 3)::DOUBLE AS duration_sec,
  {age("max(ts_ms)")} AS last_tick_age_sec FROM li GROUP BY 1""",
)
def e9_coverage(spark, sf_dir):
    return stats.coverage(stats.day_stats(_busy(spark, sf_dir)), NOW)


@query(
    "e10_lower_rank_percentiles",
    q.w(q.EV)
    + """, r AS (SELECT symbol, recv_ts_ms - ts_ms AS v,
  row_number() OVER (PARTITION BY symbol ORDER BY recv_ts_ms - ts_ms) - 1 AS pos,
  count(*) OVER (PARTITION BY symbol) AS n FROM ev),
ps AS (SELECT unnest([0.5, 0.95, 1.0])::DOUBLE AS p)
SELECT symbol, p, v AS value FROM r, ps WHERE pos = floor((n - 1) * p)""",
)
def e10_lower_rank_percentiles(spark, sf_dir):
    delays = _ticks(spark, sf_dir).select(
        "symbol", (F.col("recv_ts_ms") - F.col("ts_ms")).alias("delay_ms")
    )
    return stats.lower_rank_percentiles(delays, ["symbol"], "delay_ms", (0.5, 0.95, 1.0), 100.0)


@query(
    "e14_ingest_per_minute",
    q.w(q.RESENT)
    + """SELECT recv_ts_ms // 60000 * 60000 AS minute_ms, push_type, count(*) AS rows FROM ev
GROUP BY 1, 2""",
)
def e14_ingest_per_minute(spark, sf_dir):
    return stats.ingest_per_minute(derived.event_ticks(spark, sf_dir, resent=True))


def _batches(spark, sf_dir):
    """One commit per tick user and quarter hour: rows offered, rows with a seq, a latency."""
    ticks = _ticks(spark, sf_dir)
    slot = (F.floor(F.col("recv_ts_ms") / 900_000) * 900_000).cast("bigint")
    return ticks.groupBy(slot.alias("committed_at_ms"), "symbol").agg(
        F.count("seq").alias("inserted"),
        F.count_if(F.col("seq").isNull()).alias("ignored"),
        F.max(F.col("recv_ts_ms") - F.col("ts_ms")).alias("commit_latency_ms"),
    )


@query(
    "e15_write_summary",
    q.w(q.EV)
    + """, b AS (SELECT recv_ts_ms // 900000 * 900000 AS t0, symbol, count(seq) AS inserted,
  count(*) - count(seq) AS ignored, max(recv_ts_ms - ts_ms) AS latency FROM ev GROUP BY 1, 2),
r AS (SELECT *, t0 // 3600000 * 3600000 AS window_ms,
  row_number() OVER (PARTITION BY t0 // 3600000 ORDER BY latency) - 1 AS pos,
  count(*) OVER (PARTITION BY t0 // 3600000) AS n FROM b)
SELECT window_ms, count(*) AS batches,
  floor(sum(inserted) * 60000 / 3600000.0)::BIGINT AS inserted_per_min,
  floor(sum(ignored) * 60000 / 3600000.0)::BIGINT AS ignored_per_min,
  max(latency) FILTER (pos = floor((n - 1) * 0.5)) AS latency_p50_ms,
  max(latency) FILTER (pos = floor((n - 1) * 0.95::DOUBLE)) AS latency_p95_ms
FROM r GROUP BY 1""",
)
def e15_write_summary(spark, sf_dir):
    return stats.write_summary(_batches(spark, sf_dir), window_ms=3_600_000)


@query(
    "e16_drift",
    q.w(q.EV)
    + f"""SELECT trading_day, ({NOW} - max(ts_ms)) / 1000.0::DOUBLE AS drift_sec,
  abs({NOW} - max(ts_ms)) > 120000 AS drift_warn FROM ev GROUP BY 1""",
)
def e16_drift(spark, sf_dir):
    facts = stats.drift(stats.day_stats(_ticks(spark, sf_dir)), NOW)
    return facts.select("trading_day", "drift_sec", "drift_warn")


@query("e19_distinct_symbols", q.w(q.LI) + "SELECT DISTINCT symbol FROM li")
def e19_distinct_symbols(spark, sf_dir):
    return stats.distinct_symbols(_busy(spark, sf_dir))


@query(
    "f6_ingest_ranking",
    q.w(q.EV)
    + """SELECT symbol, trading_day, ts_ms, row_number() OVER (PARTITION BY trading_day, symbol
  ORDER BY ts_ms, coalesce(seq, -1), ingest_ordinal) AS position FROM ev""",
)
def f6_ingest_ranking(spark, sf_dir):
    return stats.export_positions(_ticks(spark, sf_dir)).select(
        "symbol", "trading_day", "ts_ms", "position"
    )


@query(
    "g1_latest_ticks",
    q.w(q.EV)
    + """SELECT symbol, ts_ms, price, volume, turnover, seq FROM ev WHERE symbol = 'HK.purchase'
ORDER BY ts_ms DESC, seq DESC NULLS LAST, ingest_ordinal DESC LIMIT 20""",
)
def g1_latest_ticks(spark, sf_dir):
    return stats.latest_ticks(_ticks(spark, sf_dir), 20, "HK.purchase").select(
        "symbol", "ts_ms", "price", "volume", "turnover", "seq"
    )


@query(
    "g1_symbol_last_500",
    q.w(q.EV)
    + """SELECT symbol, ts_ms, price, volume, turnover, seq FROM ev WHERE symbol = 'HK.view'
ORDER BY ts_ms DESC, seq DESC NULLS LAST, ingest_ordinal DESC LIMIT 500""",
)
def g1_symbol_last_500(spark, sf_dir):
    """The command's newest ticks of a symbol, as many as asked for."""
    from . import commands

    rows = commands.db_symbol(_ticks(spark, sf_dir), "HK.view", last=500, with_time=True)
    return rows.select("symbol", "ts_ms", "price", "volume", "turnover", "seq")


@query(
    "g1_latest_ticks_all_symbols",
    q.w(q.LI)
    + """SELECT symbol, ts_ms, seq, rank FROM (SELECT *, row_number() OVER (PARTITION BY symbol
  ORDER BY ts_ms DESC, seq DESC NULLS LAST, l_partkey DESC)::INTEGER AS rank FROM li)
WHERE rank <= 20""",
)
def g1_latest_ticks_all_symbols(spark, sf_dir):
    ticks = _busy(spark, sf_dir).withColumnRenamed("l_partkey", "ingest_ordinal")
    return stats.latest_ticks(ticks, 20).select("symbol", "ts_ms", "seq", "rank")


@query(
    "g2_export_order",
    q.w(q.LI)
    + """SELECT trading_day, symbol, seq, ts_ms, row_number() OVER (PARTITION BY trading_day, symbol
  ORDER BY ts_ms, coalesce(seq, -1), l_partkey, price, volume, turnover) AS position FROM li""",
)
def g2_export_order(spark, sf_dir):
    """Each tick's place in its day and symbol; the files lie by day and symbol."""
    ordinal = ["l_partkey", "price", "volume", "turnover"]
    return stats.export_positions(_busy(spark, sf_dir), ordinal, slice_ms=3_600_000).select(
        "trading_day", "symbol", "seq", "ts_ms", "position"
    )


@query(
    "g3_top_rows",
    q.w(q.LI)
    + """, s AS (SELECT trading_day, symbol, count(*) AS rows, max(ts_ms) AS latest_ts_ms FROM li
  GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trading_day ORDER BY rows DESC, symbol)::INTEGER
  AS rank FROM s) WHERE rank <= 5""",
)
def g3_top_rows(spark, sf_dir):
    return stats.top_rows(stats.symbol_stats(_busy(spark, sf_dir)), 5).drop("min_ts_ms")


STATUS_TOP = """, s AS (SELECT trading_day, symbol, count(*) AS rows FROM li GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY trading_day ORDER BY rows DESC, symbol)::INTEGER AS rank
  FROM s)"""


@query(
    "g4_limit_then_filter",
    q.w(q.LI)
    + STATUS_TOP
    + "SELECT * FROM r WHERE rank <= 5 AND symbol IN ('HK.00007', 'HK.00050', 'HK.00099')",
)
def g4_limit_then_filter(spark, sf_dir):
    per_symbol = stats.symbol_stats(_busy(spark, sf_dir)).select("trading_day", "symbol", "rows")
    return stats.status_symbols(per_symbol, ["HK.00007", "HK.00050", "HK.00099"], 5)


@query(
    "c8_name_and_day_checks",
    f"""SELECT p_partkey, regexp_matches(upper(trim(p_name)), '^[A-Za-z0-9._-]{{2,24}}$') AS name_ok
FROM part""",
)
def c8_name_and_day_checks(spark, sf_dir):
    part = derived.table(spark, sf_dir, "part")
    return part.select("p_partkey", text.is_symbol_name("p_name").alias("name_ok"))


@query(
    "c8_day_lookback",
    """SELECT o_orderkey, datediff('day', o_orderdate::DATE, DATE '1999-06-30') BETWEEN 0 AND 30
  AS in_range FROM orders""",
)
def c8_day_lookback(spark, sf_dir):
    orders = derived.table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return orders.select(
        "o_orderkey", clock.within_lookback(day, F.lit("19990630"), 30).alias("in_range")
    )


@query(
    "cmd_db_symbols",
    q.w(q.LI)
    + f"""SELECT symbol, count(*) AS rows, {q.clock("max(ts_ms)")} AS latest_local,
  {age("max(ts_ms)")} AS last_tick_age_sec FROM li GROUP BY 1""",
)
def cmd_db_symbols(spark, sf_dir):
    from . import commands

    return commands.db_symbols(_busy(spark, sf_dir), NOW)
