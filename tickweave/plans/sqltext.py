"""SQL text shared by the checks: the derived inputs, written independently of the Spark code."""

from __future__ import annotations

HK_MS = 28_800_000


def local(ts: str) -> str:
    return f"make_timestamp_ms({ts} + {HK_MS})"


def day(ts: str) -> str:
    return f"strftime({local(ts)}, '%Y%m%d')"


def clock(ts: str) -> str:
    return f"strftime({local(ts)}, '%Y-%m-%d %H:%M:%S')"


def msod(ts: str) -> str:
    return f"(({ts} + {HK_MS}) % 86400000)"


def session(ts: str) -> str:
    return (
        f"CASE WHEN isodow({local(ts)}) >= 6 THEN NULL "
        f"WHEN {msod(ts)} >= 34200000 AND {msod(ts)} < 43200000 THEN 0 "
        f"WHEN {msod(ts)} >= 46800000 AND {msod(ts)} < 57600000 THEN 1 END"
    )


def phase(ts: str, holiday: str = "FALSE") -> str:
    m = msod(ts)
    return (
        f"CASE WHEN isodow({local(ts)}) >= 6 THEN 'after-hours' "
        f"WHEN {holiday} THEN 'holiday-closed' "
        f"WHEN {m} >= 32400000 AND {m} < 34200000 THEN 'pre-open' "
        f"WHEN {m} >= 34200000 AND {m} < 43200000 THEN 'open' "
        f"WHEN {m} >= 43200000 AND {m} < 46800000 THEN 'lunch-break' "
        f"WHEN {m} >= 46800000 AND {m} < 57600000 THEN 'open' ELSE 'after-hours' END"
    )


_BASE = f"""ev0 AS (
SELECT 'HK' AS market, 'HK.' || event_type AS symbol, (epoch_us(ts) // 1000) AS ts_ms,
  CASE WHEN event_id % 77 <> 0 THEN value END AS price,
  1 + user_id % 100 AS volume,
  CASE WHEN event_id % 77 <> 0 THEN round(value * (1 + user_id % 100), 2) END AS turnover,
  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS direction,
  CASE WHEN event_id % 7 <> 0 THEN event_id END AS seq,
  'AUTO_MATCH' AS tick_type,
  CASE event_id % 3 WHEN 0 THEN 'push' WHEN 1 THEN 'poll' ELSE 'backfill' END AS push_type,
  'feed' AS provider,
  {day("(epoch_us(ts) // 1000)")} AS trading_day,
  (epoch_us(ts) // 1000) + event_id % 5000 AS recv_ts_ms,
  (epoch_us(ts) // 1000) + event_id % 5000 AS inserted_at_ms,
  event_id * 2 AS ingest_ordinal, user_id
FROM events)"""

EV = _BASE + ",\nev AS (SELECT * EXCLUDE (user_id) FROM ev0)"

RESENT = (
    _BASE
    + """,
ev AS (SELECT * EXCLUDE (user_id) FROM ev0
 UNION ALL
 SELECT * EXCLUDE (user_id) REPLACE ('poll' AS push_type, recv_ts_ms + 7000 AS recv_ts_ms,
   inserted_at_ms + 7000 AS inserted_at_ms, ingest_ordinal + 1 AS ingest_ordinal)
 FROM ev0 WHERE user_id < 30)"""
)

LI = f"""li0 AS (
SELECT *, (epoch_us(l_shipdate) // 1000) + 5400000 + (l_orderkey * 7919 + l_linenumber * 104729) % 23400000
  AS ts_ms FROM lineitem),
li AS (
SELECT 'HK' AS market, 'HK.' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS symbol, ts_ms,
  l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume,
  l_extendedprice AS turnover,
  CASE l_returnflag WHEN 'A' THEN 'BUY' WHEN 'R' THEN 'SELL' END AS direction,
  l_orderkey * 8 + l_linenumber AS seq, 'AUTO_MATCH' AS tick_type, 'push' AS push_type,
  'feed' AS provider, {day("ts_ms")} AS trading_day, ts_ms AS recv_ts_ms, ts_ms AS inserted_at_ms,
  l_partkey, l_discount, l_tax, l_linestatus
FROM li0)"""

ALONE = "(seq IS NULL AND (price IS NULL OR volume IS NULL OR turnover IS NULL))"

# first arrival per key; rows that equal no other row are all kept
KEPT = f"""kept AS (
SELECT * EXCLUDE (rn) FROM (
  SELECT *, CASE WHEN {ALONE} THEN 1 WHEN seq IS NOT NULL
    THEN row_number() OVER (PARTITION BY trading_day, symbol, seq ORDER BY recv_ts_ms, ingest_ordinal)
    ELSE row_number() OVER (PARTITION BY trading_day, symbol, seq, ts_ms, price, volume, turnover
      ORDER BY recv_ts_ms, ingest_ordinal) END AS rn
  FROM ev) WHERE rn = 1)"""

# scaled thresholds: 6 h window, 5 ticks, 1 h gap, 1.5 h stall
POINTS = """pts AS (
SELECT symbol, ts_ms, trading_day,
  lag(ts_ms) OVER (PARTITION BY symbol ORDER BY ts_ms) AS prev_ts_ms,
  count(*) OVER (PARTITION BY symbol ORDER BY ts_ms RANGE BETWEEN 21600000 PRECEDING AND CURRENT ROW)
    AS active_count
FROM (SELECT symbol, ts_ms, min(trading_day) AS trading_day FROM ev GROUP BY ALL))"""

DAY_POINTS = """dpts AS (
SELECT symbol, ts_ms, trading_day,
  lag(ts_ms) OVER (PARTITION BY trading_day, symbol ORDER BY ts_ms) AS prev_ts_ms,
  count(*) OVER (PARTITION BY trading_day, symbol ORDER BY ts_ms
    RANGE BETWEEN 21600000 PRECEDING AND CURRENT ROW) AS active_count
FROM (SELECT DISTINCT symbol, ts_ms, trading_day FROM ev))"""

GAPS = f"""gaps AS (
SELECT trading_day, symbol, prev_ts_ms AS gap_start_ts_ms, ts_ms AS gap_end_ts_ms,
  (ts_ms - prev_ts_ms) / 1000.0 AS gap_sec, ts_ms - prev_ts_ms AS gap_ms, active_count
FROM pts WHERE active_count >= 5 AND prev_ts_ms IS NOT NULL
  AND ({session("prev_ts_ms")}) = ({session("ts_ms")}) AND ts_ms - prev_ts_ms > 3600000)"""

STALLS = f"""stalls AS (
SELECT trading_day, symbol, prev_ts_ms AS stall_start_ts_ms, ts_ms AS stall_end_ts_ms,
  ts_ms - prev_ts_ms AS delta_ms
FROM dpts WHERE active_count >= 5 AND prev_ts_ms IS NOT NULL
  AND ({session("prev_ts_ms")}) = ({session("ts_ms")}) AND ts_ms - prev_ts_ms > 5400000)"""


def w(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
