"""Minute features, day levels and microstructure events, on hourly buckets of the sparse events."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..operators import events, features, levels
from ..sources import derived
from . import sqltext as q
from .catalog import query

P = derived.SPARSE_MICRO
NOW = derived.NOW_MS

TRADES = """tk0 AS (
SELECT *, ts_ms // 3600000 * 3600000 AS b,
  lag(price) OVER w AS pp, lag(ts_ms) OVER w AS pts, row_number() OVER w AS rn
FROM ev WHERE price IS NOT NULL
WINDOW w AS (PARTITION BY symbol, trading_day ORDER BY ts_ms, coalesce(seq, -1), price, volume)),
tk AS (
SELECT *, last_value(nullif(sign(price - pp), 0) IGNORE NULLS) OVER (
  PARTITION BY symbol, trading_day ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sgn
FROM tk0)"""

FEAT = """f0 AS (
SELECT b AS ts_min_ms, symbol, trading_day, count(*) AS ticks, sum(volume)::BIGINT AS volume,
  sum(coalesce(turnover, price * volume)) AS turnover, arg_min(price, rn) AS open, max(price) AS high,
  min(price) AS low, arg_max(price, rn) AS close,
  coalesce(sum(volume) FILTER (direction = 'BUY' OR (direction IS NULL AND sgn > 0)), 0)::BIGINT
    AS buy_volume,
  coalesce(sum(volume) FILTER (direction = 'SELL' OR (direction IS NULL AND sgn < 0)), 0)::BIGINT
    AS sell_volume,
  count(*) FILTER (abs(price - pp) >= 3.0::DOUBLE - 1e-9 AND pts >= b) AS jump_count
FROM tk GROUP BY 1, 2, 3),
feat AS (
SELECT *, (buy_volume - sell_volume) / (buy_volume + sell_volume + 1e-9::DOUBLE) AS imbalance,
  abs(close - open) / open AS abs_return, close - open AS price_change,
  abs(close - open) / (volume + 1e-9::DOUBLE) AS impact FROM f0)"""

PROFILE = f"""pr0 AS (
SELECT *, floor(round(price / 5.0::DOUBLE, 6))::BIGINT AS bin, {q.msod("ts_ms")} AS ms,
  row_number() OVER (PARTITION BY symbol, trading_day ORDER BY ts_ms, coalesce(seq, -1), price, volume)
  AS rn FROM ev WHERE price IS NOT NULL),
prof AS (
SELECT trading_day, symbol, bin, sum(volume)::BIGINT AS vol,
  coalesce(sum(volume) FILTER (ms < 32400000), 0)::BIGINT AS open_vol
FROM pr0 GROUP BY 1, 2, 3),
figs AS (
SELECT trading_day, symbol, sum(volume)::BIGINT AS total_volume,
  round(sum(coalesce(turnover, price * volume)), 2) AS total_turnover, max(price) AS high,
  min(price) AS low, arg_max(price, rn) AS close,
  max(price) FILTER (ms < 32400000) - min(price) FILTER (ms < 32400000) AS open_auc_range,
  max(price) FILTER (ms >= 57600000 AND ms < 72000000)
    - min(price) FILTER (ms >= 57600000 AND ms < 72000000) AS close_auc_range,
  coalesce(sum(volume) FILTER (ms >= 57600000 AND ms < 72000000), 0)::BIGINT AS close_vol,
  coalesce(sum(volume) FILTER (ms < 32400000), 0)::BIGINT AS open_vol,
  arg_min(price, rn) FILTER (ms < 32400000) AS o1, arg_max(price, rn) FILTER (ms < 32400000) AS o2,
  arg_min(price, rn) FILTER (ms >= 34200000 AND ms < 43200000) AS c1,
  arg_max(price, rn) FILTER (ms >= 34200000 AND ms < 43200000) AS c2,
  max(ts_ms) FILTER (ms >= 34200000 AND ms < 43200000) AS c_ts
FROM pr0 GROUP BY 1, 2),
va0 AS (
SELECT *, row_number() OVER r AS rk, sum(vol) OVER r - vol AS before,
  sum(vol) OVER (PARTITION BY trading_day, symbol) AS total
FROM prof WINDOW r AS (PARTITION BY trading_day, symbol ORDER BY vol DESC, bin
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
va AS (
SELECT trading_day, symbol, (max(bin) FILTER (rk = 1) * 5.0)::DOUBLE AS poc,
  (max(bin) FILTER (rk = 1 OR before < total * 0.7::DOUBLE) * 5.0)::DOUBLE AS vah,
  (min(bin) FILTER (rk = 1 OR before < total * 0.7::DOUBLE) * 5.0)::DOUBLE AS val
FROM va0 GROUP BY 1, 2),
nodes AS (
SELECT trading_day, symbol, (bin * 5.0)::DOUBLE AS price, vol,
  CASE WHEN vol > lo AND vol > hi THEN 'hvn' WHEN vol < lo AND vol < hi THEN 'lvn' END AS kind
FROM (SELECT *, lag(vol) OVER p AS lo, lead(vol) OVER p AS hi FROM prof
  WINDOW p AS (PARTITION BY trading_day, symbol ORDER BY bin)))"""

GATED = """g0 AS (
SELECT f.*, poc, vah, val, (close BETWEEN val AND vah)::INTEGER AS in_value_area,
  (close > vah)::INTEGER AS above_vah, (close < val)::INTEGER AS below_val, close - poc AS dist_to_poc,
  max(high) OVER r - min(low) OVER r AS recent_range
FROM feat f LEFT JOIN va USING (symbol, trading_day)
WINDOW r AS (PARTITION BY symbol ORDER BY ts_min_ms RANGE BETWEEN 7200000 PRECEDING AND CURRENT ROW)),
g1 AS (
SELECT *,
  CASE WHEN count(*) OVER s >= 10 THEN quantile_cont(abs_return, 0.3) OVER s END AS ret_absorb,
  CASE WHEN count(*) OVER s >= 10 THEN quantile_cont(abs_return, 0.7) OVER s END AS ret_reject,
  CASE WHEN count(*) OVER s >= 10 THEN quantile_cont(abs_return, 0.8) OVER s END AS ret_init,
  CASE WHEN count(*) OVER s >= 10 THEN quantile_cont(impact, 0.5) OVER s END AS impact_median,
  CASE WHEN count(*) OVER s >= 10 THEN quantile_cont(impact, 0.8) OVER s END AS impact_init,
  CASE WHEN count(*) OVER s >= 10 THEN quantile_cont(volume::DOUBLE, 0.7) OVER s END AS volume_absorb,
  CASE WHEN count(*) OVER l >= 10 THEN quantile_cont(impact, 0.9) OVER l END AS impact_vacuum,
  CASE WHEN count(*) OVER l >= 10 THEN quantile_cont(recent_range, 0.2) OVER l END AS range_compress,
  CASE WHEN count(*) OVER l >= 10 THEN quantile_cont(ticks::DOUBLE, 0.3) OVER l END AS ticks_compress,
FROM g0 WINDOW
  s AS (PARTITION BY symbol ORDER BY ts_min_ms RANGE BETWEEN 86400000 PRECEDING AND 1 PRECEDING),
  l AS (PARTITION BY symbol ORDER BY ts_min_ms RANGE BETWEEN 172800000 PRECEDING AND 1 PRECEDING)),
g2 AS (
SELECT *, lag(close) OVER d AS prev_close, lag(high) OVER d AS prev_high, lag(low) OVER d AS prev_low,
  lag(in_value_area) OVER d AS prev_in, lag(above_vah, 2) OVER d AS came_above,
  lag(below_val, 2) OVER d AS came_below,
  coalesce(recent_range <= range_compress AND ticks <= ticks_compress, FALSE) AS compressed,
  ts_min_ms // 10800000 * 10800000 AS comp_bucket,
  coalesce(abs_return >= ret_init AND impact >= impact_init AND price_change <> 0
    AND sign(price_change) = sign(imbalance), FALSE) AS initiation
FROM g1 WINDOW d AS (PARTITION BY symbol, trading_day ORDER BY ts_min_ms)),
ctx AS (
SELECT *, max(CASE WHEN compressed THEN comp_bucket END) OVER (PARTITION BY symbol, trading_day
  ORDER BY ts_min_ms RANGE BETWEEN 86400000 PRECEDING AND 1 PRECEDING) AS last_comp,
  symbol || '|' || trading_day || '|' AS k FROM g2),
cross0 AS (
SELECT c.*, n.price AS lvn FROM ctx c JOIN nodes n USING (symbol, trading_day)
WHERE n.kind = 'lvn' AND ((prev_close < n.price AND n.price <= close)
  OR (prev_close > n.price AND n.price >= close))),
anycross AS (SELECT symbol, ts_min_ms, count(*) AS n_cross FROM cross0 GROUP BY 1, 2)"""

COLUMNS = "ts_ms, symbol, event_type, severity, score, dedup_key, cooldown_sec"
_CLAMP = "round(least(100.0, greatest(0.0, ({0})::DOUBLE)), 3)::DOUBLE AS score"


def _sql(select: str, severity: str, score: str, key: str, cooldown: int, frm: str) -> str:
    return (
        f"SELECT ts_min_ms AS ts_ms, symbol, {select} AS event_type, '{severity}' AS severity, "
        f"{_CLAMP.format(score)}, k || {key} AS dedup_key, {cooldown} AS cooldown_sec FROM {frm}"
    )


_UP = "price_change > 0"
_DIR = f"CASE WHEN {_UP} THEN 'up' ELSE 'down' END"
_RUP = (
    "CASE WHEN initiation THEN price_change > 0 ELSE close >= prev_close END"
)
_NEAREST = "least(abs(close - poc), abs(close - vah), abs(close - val))"

EVENT_SQL = {
    "VALUE_ACCEPTANCE": _sql(
        "'VALUE_ACCEPTANCE'", "INFO", "50.0", "'VA_ACCEPT'", 1800,
        "ctx WHERE in_value_area = 1 AND prev_in = 1 AND (came_above = 1 OR came_below = 1)",
    ),
    "VALUE_REJECTION": _sql(
        "'VALUE_REJECTION'", "WARN", "50 + 25 * least(2.0, abs_return / (ret_reject + 1e-9::DOUBLE))",
        "'VA_REJECT|' || CASE WHEN prev_high >= vah AND close > vah THEN 'VAH' ELSE 'VAL' END", 900,
        """ctx WHERE ((prev_high >= vah AND close > vah) OR (prev_low <= val AND close < val))
  AND abs_return > ret_reject""",
    ),
    "LVN_BREAKOUT": _sql(
        "CASE WHEN close >= prev_close THEN 'LVN_BREAKOUT_UP' ELSE 'LVN_BREAKOUT_DOWN' END", "ALERT",
        "60 + 10 * least(4.0, impact / (impact_median + 1e-9::DOUBLE))",
        """'LVN|price=' || lvn::DECIMAL(18, 4) || '|dir=' ||
  CASE WHEN close >= prev_close THEN 'up' ELSE 'down' END""", 1200,
        "cross0 WHERE impact > impact_median * 2.0::DOUBLE",
    ),
    "ABSORPTION": _sql(
        "CASE WHEN imbalance > 0 THEN 'ABSORPTION_BUY' ELSE 'ABSORPTION_SELL' END", "WARN",
        f"""40 * least(1.0, volume / (volume_absorb + 1e-9::DOUBLE) / 2)
  + 40 * (1 - CASE WHEN abs_return = 0 THEN 0.0 ELSE least(1.0, abs_return / ret_absorb) END)
  + 20 * ({_NEAREST} <= 5.0)::INTEGER""",
        f"""'ABSORB|side=' || CASE WHEN imbalance > 0 THEN 'buy' ELSE 'sell' END || '|level=' ||
  CASE WHEN abs(close - poc) = {_NEAREST} THEN 'POC' WHEN abs(close - vah) = {_NEAREST} THEN 'VAH'
  ELSE 'VAL' END""", 900,
        """ctx WHERE abs(imbalance) >= 0.35::DOUBLE AND abs_return <= ret_absorb
  AND volume >= volume_absorb""",
    ),
    "INITIATION": _sql(
        f"CASE WHEN {_UP} THEN 'INITIATION_UP' ELSE 'INITIATION_DOWN' END", "ALERT",
        "60 + 20 * (coalesce(n_cross, 0) > 0)::INTEGER + 20 * (above_vah = 1 OR below_val = 1)::INTEGER",
        f"'INIT|dir=' || {_DIR} || '|band=' || CASE WHEN in_value_area = 1 THEN 'va' ELSE 'outer' END",
        600, "ctx LEFT JOIN anycross USING (symbol, ts_min_ms) WHERE initiation",
    ),
    "LIQUIDITY_VACUUM": _sql(
        f"CASE WHEN {_UP} THEN 'LIQUIDITY_VACUUM_UP' ELSE 'LIQUIDITY_VACUUM_DOWN' END", "ALERT",
        "60 + 20 * least(2.0, impact / (impact_vacuum + 1e-9::DOUBLE))",
        f"'VACUUM|dir=' || {_DIR} || '|impact_band=p90+'", 900,
        """ctx WHERE impact >= impact_vacuum AND price_change <> 0
  AND (jump_count >= 1 OR abs(price_change) >= 3.0::DOUBLE - 1e-9)""",
    ),
    "RANGE_COMPRESSION": _sql(
        "'RANGE_COMPRESSION'", "INFO", "40.0", "'COMP|15m_bucket=' || comp_bucket", 1800, "ctx WHERE compressed",
    ),
    "BREAKOUT_RELEASE": _sql(
        f"CASE WHEN {_RUP} THEN 'BREAKOUT_RELEASE_UP' ELSE 'BREAKOUT_RELEASE_DOWN' END", "ALERT",
        """80.0 + 10 * initiation::INTEGER
  + 10 * coalesce(n_cross > 0 AND impact > impact_median * 2.0::DOUBLE, FALSE)::INTEGER""",
        f"""'RELEASE|dir=' || CASE WHEN {_RUP} THEN 'up' ELSE 'down' END || '|from_comp=' ||
  last_comp""", 1200,
        """ctx LEFT JOIN anycross USING (symbol, ts_min_ms) WHERE last_comp IS NOT NULL
  AND (initiation OR coalesce(n_cross > 0 AND impact > impact_median * 2.0::DOUBLE, FALSE))""",
    ),
    "OPEN_IMBALANCE": f"""SELECT c_ts AS ts_ms, symbol, 'OPEN_IMBALANCE' AS event_type, 'WARN' AS severity,
  {_CLAMP.format("top3 / open_vol * 100")}, symbol || '|' || trading_day || '|OPEN_IMB' AS dedup_key,
  86400 AS cooldown_sec
FROM figs JOIN (SELECT trading_day, symbol, sum(open_vol)::BIGINT AS top3 FROM (
  SELECT *, row_number() OVER (PARTITION BY trading_day, symbol ORDER BY open_vol DESC, bin) AS rk
  FROM prof WHERE open_vol > 0) WHERE rk <= 3 GROUP BY 1, 2) USING (trading_day, symbol)
WHERE top3 / open_vol >= 0.3::DOUBLE AND sign(o2 - o1) <> 0 AND sign(o2 - o1) = sign(c2 - c1)""",
    "CLOSE_AUCTION_DOMINANCE": f"""SELECT
  epoch_ms(strptime(trading_day, '%Y%m%d')) - 28800000 + 72000000 AS ts_ms, symbol,
  'CLOSE_AUCTION_DOMINANCE' AS event_type, 'ALERT' AS severity,
  {_CLAMP.format("50 + 50 * least(1.0, close_vol / total_volume + abs(close - poc) / (high - low))")},
  symbol || '|' || trading_day || '|CLOSE_DOM' AS dedup_key, 86400 AS cooldown_sec
FROM figs JOIN va USING (trading_day, symbol) WHERE high > low
  AND close_vol / total_volume >= 0.12::DOUBLE AND abs(close - poc) / (high - low) >= 0.05::DOUBLE""",
}

BASE = q.w(q.EV, TRADES, FEAT, PROFILE, GATED)


def _ticks(spark, sf_dir):
    return derived.event_ticks(spark, sf_dir)


def _features(spark, sf_dir):
    return features.minute_features(_ticks(spark, sf_dir), P)


def _profile(spark, sf_dir):
    return levels.day_profile(_ticks(spark, sf_dir), P)


def _levels(spark, sf_dir):
    return levels.levels_daily(_profile(spark, sf_dir), P)


def _gated(spark, sf_dir):
    placed = features.with_levels(_features(spark, sf_dir), _levels(spark, sf_dir), P)
    return features.with_gates(placed, P)


def _events(spark, sf_dir):
    """All ten event types."""
    days = levels.day_levels(_profile(spark, sf_dir), P)
    return events.all_events(_features(spark, sf_dir), days, P, NOW)


def _bucket_events(spark, sf_dir, prefix):
    ctx = events.with_context(_gated(spark, sf_dir), P)
    found = events.bucket_events(ctx, P, NOW)
    return found.where(F.col("event_type").startswith(prefix)).drop("payload_json", "created_at_ms", "trading_day")


def _rounded(df, places, *names):
    return df.withColumns({n: F.round(n, places) for n in names})


FEATURE_ROWS = """SELECT ts_min_ms, symbol, trading_day, ticks, volume, round(turnover, 2) AS turnover,
  open, high, low, close, buy_volume, sell_volume, round(imbalance, 6) AS imbalance,
  round(abs_return, 6) AS abs_return, round(price_change, 6) AS price_change,
  round(impact, 6) AS impact FROM feat"""


@query("k1_minute_features", q.w(q.EV, TRADES, FEAT) + FEATURE_ROWS)
def k1_minute_features(spark, sf_dir):
    out = _rounded(
        _features(spark, sf_dir), 6, "imbalance", "abs_return", "price_change", "impact"
    )
    return _rounded(out, 2, "turnover").drop("jump_count")


@query(
    "k1_minute_features_lineitem",
    q.w(
        q.LI.replace("li AS", "ev AS"),
        TRADES.replace("3600000", "60000"),
        FEAT,
    )
    + """SELECT ts_min_ms, symbol, ticks, volume, open, high, low, close, buy_volume, sell_volume FROM feat""",
)
def k1_minute_features_lineitem(spark, sf_dir):
    """True one-minute buckets over many symbols."""
    params = dataclasses.replace(P, bucket_ms=60_000)
    ticks = derived.lineitem_ticks(spark, sf_dir)
    return features.minute_features(ticks, params).select(
        "ts_min_ms", "symbol", "ticks", "volume", "open", "high", "low", "close", "buy_volume",
        "sell_volume",
    )


@query(
    "k2_tick_rule",
    q.w(q.EV, TRADES) + "SELECT symbol, ts_ms, seq, price, sgn::DOUBLE AS tick_sign FROM tk",
)
def k2_tick_rule(spark, sf_dir):
    sided = features.tick_sides(_ticks(spark, sf_dir), P)
    return sided.select("symbol", "ts_ms", "seq", "price", "tick_sign")


@query(
    "k3_jump_count",
    q.w(q.EV, TRADES, FEAT) + "SELECT symbol, ts_min_ms, jump_count FROM feat",
)
def k3_jump_count(spark, sf_dir):
    return _features(spark, sf_dir).select("symbol", "ts_min_ms", "jump_count")


@query(
    "k4_profile_position",
    BASE
    + """SELECT symbol, ts_min_ms, round(dist_to_poc, 6) AS dist_to_poc, in_value_area, above_vah,
  below_val FROM g0""",
)
def k4_profile_position(spark, sf_dir):
    placed = features.with_levels(_features(spark, sf_dir), _levels(spark, sf_dir), P)
    return _rounded(placed, 6, "dist_to_poc").select(
        "symbol", "ts_min_ms", "dist_to_poc", "in_value_area", "above_vah", "below_val"
    )


@query(
    "d9_previous_day_levels",
    q.w(q.EV, TRADES, FEAT, PROFILE)
    + """, shifted AS (SELECT symbol, lead(trading_day) OVER (PARTITION BY symbol ORDER BY trading_day)
  AS trading_day, poc FROM va)
SELECT symbol, ts_min_ms, round(close - poc, 6) AS dist_to_poc FROM feat
LEFT JOIN shifted USING (symbol, trading_day)""",
)
def d9_previous_day_levels(spark, sf_dir):
    """Features against the levels of the newest earlier day."""
    params = dataclasses.replace(P, levels_mode="prev_day")
    placed = features.with_levels(_features(spark, sf_dir), _levels(spark, sf_dir), params)
    return _rounded(placed, 6, "dist_to_poc").select("symbol", "ts_min_ms", "dist_to_poc")


@query(
    "k5_compression_release",
    BASE
    + """SELECT symbol, ts_min_ms, round(CASE WHEN range_compress > 0 THEN recent_range / range_compress END,
  6) AS compression_score, round(CASE WHEN impact_init > 0 THEN impact / impact_init END, 6)
  AS release_score FROM g1""",
)
def k5_compression_release(spark, sf_dir):
    out = _rounded(_gated(spark, sf_dir), 6, "compression_score", "release_score")
    return out.select("symbol", "ts_min_ms", "compression_score", "release_score")


@query(
    "k6_volume_profile",
    q.w(q.EV, PROFILE)
    + "SELECT trading_day, symbol, (bin * 5.0)::DOUBLE AS price, vol FROM prof",
)
def k6_volume_profile(spark, sf_dir):
    return levels.volume_profile(_ticks(spark, sf_dir), P)


@query(
    "k6_volume_profile_lineitem",
    q.w(q.LI)
    + """SELECT trading_day, symbol, floor(round(price / 50.0, 6))::BIGINT * 50.0::DOUBLE AS price,
  sum(volume)::BIGINT AS vol FROM li GROUP BY 1, 2, 3""",
)
def k6_volume_profile_lineitem(spark, sf_dir):
    params = dataclasses.replace(P, price_bin=50.0)
    return levels.volume_profile(derived.lineitem_ticks(spark, sf_dir), params)


@query("k7_value_area", q.w(q.EV, PROFILE) + "SELECT * FROM va")
def k7_value_area(spark, sf_dir):
    return levels.value_area(_profile(spark, sf_dir), P)


@query(
    "k8_volume_nodes",
    q.w(q.EV, PROFILE)
    + "SELECT trading_day, symbol, kind, price, vol FROM nodes WHERE kind IS NOT NULL",
)
def k8_volume_nodes(spark, sf_dir):
    nodes = levels.volume_nodes(_profile(spark, sf_dir), P)
    flat = [
        nodes.select(
            "trading_day", "symbol", F.lit(kind).alias("kind"), F.inline(kind)
        )
        for kind in ("hvn", "lvn")
    ]
    return flat[0].unionByName(flat[1])


@query(
    "k9_day_figures",
    q.w(q.EV, PROFILE)
    + """SELECT trading_day, symbol, total_volume, total_turnover, round(open_auc_range, 6) AS open_auc_range,
  round(close_auc_range, 6) AS close_auc_range, round(CASE WHEN high > low
    THEN (close - low) / (high - low) END, 6) AS close_strength_score, poc, vah, val,
  '1' AS calc_version FROM figs JOIN va USING (trading_day, symbol)""",
)
def k9_day_figures(spark, sf_dir):
    lev = _levels(spark, sf_dir).select(
        "trading_day", "symbol", "total_volume", "total_turnover", "open_auc_range",
        "close_auc_range", "close_strength_score", "poc", "vah", "val", "calc_version",
    )
    lev = _rounded(lev, 6, "open_auc_range", "close_auc_range", "close_strength_score")
    return _rounded(lev, 2, "total_turnover")


@query(
    "k20_trailing_percentiles",
    BASE
    + """SELECT symbol, ts_min_ms, round(ret_absorb, 6) AS ret_absorb, round(ret_reject, 6) AS ret_reject,
  round(impact_median, 6) AS impact_median, round(volume_absorb, 6) AS volume_absorb,
  round(impact_vacuum, 6) AS impact_vacuum, round(ticks_compress, 6) AS ticks_compress FROM g1""",
)
def k20_trailing_percentiles(spark, sf_dir):
    names = (
        "ret_absorb", "ret_reject", "impact_median", "volume_absorb", "impact_vacuum",
        "ticks_compress",
    )
    return _rounded(_gated(spark, sf_dir), 6, *names).select("symbol", "ts_min_ms", *names)


def _event_query(number: int, slug: str, prefix: str) -> None:
    @query(f"k{number}_{slug}", BASE + EVENT_SQL[prefix])
    def run(spark, sf_dir):
        return _bucket_events(spark, sf_dir, prefix)


_event_query(10, "value_acceptance", "VALUE_ACCEPTANCE")
_event_query(11, "value_rejection", "VALUE_REJECTION")
_event_query(12, "lvn_breakout", "LVN_BREAKOUT")
_event_query(13, "absorption", "ABSORPTION")
_event_query(14, "initiation", "INITIATION")
_event_query(15, "liquidity_vacuum", "LIQUIDITY_VACUUM")
_event_query(18, "range_compression", "RANGE_COMPRESSION")
_event_query(19, "breakout_release", "BREAKOUT_RELEASE")


@query("k16_open_imbalance", q.w(q.EV, PROFILE) + EVENT_SQL["OPEN_IMBALANCE"])
def k16_open_imbalance(spark, sf_dir):
    days = levels.day_levels(_profile(spark, sf_dir), P)
    found = events.open_imbalance(days, P, NOW)
    return found.drop("payload_json", "created_at_ms", "trading_day")


@query("k17_close_dominance", q.w(q.EV, PROFILE) + EVENT_SQL["CLOSE_AUCTION_DOMINANCE"])
def k17_close_dominance(spark, sf_dir):
    found = events.close_dominance(_levels(spark, sf_dir), P, NOW)
    return found.drop("payload_json", "created_at_ms", "trading_day")


ALL_SQL = ",\nall_events AS (\n" + "\nUNION ALL\n".join(EVENT_SQL.values()) + ")\n"


@query("k21_all_events", BASE + ALL_SQL + f"SELECT DISTINCT {COLUMNS} FROM all_events")
def k21_all_events(spark, sf_dir):
    found = _events(spark, sf_dir)
    twice = events.distinct_events(found.unionByName(found))
    return twice.drop("payload_json", "created_at_ms", "trading_day")


@query("k21_event_tables", BASE + ALL_SQL + f"SELECT DISTINCT {COLUMNS} FROM all_events")
def k21_event_tables(spark, sf_dir):
    """Features, levels and events built as tables from a stored tick table; with hourly buckets no
    event falls into a cooldown."""
    from . import commands
    from .ingest_queries import _loaded_store

    store = _loaded_store(spark, sf_dir)
    commands.build_micro_tables(store, P, NOW)
    return commands.micro_table(store, "events").select(*COLUMNS.split(", "))


@query(
    "k21_event_tables_by_day", BASE + ALL_SQL + f"SELECT DISTINCT {COLUMNS} FROM all_events"
)
def k21_event_tables_by_day(spark, sf_dir):
    """The same tables built in three goes of neighbouring days, as a nightly run would."""
    from . import commands
    from .ingest_queries import _loaded_store

    store = _loaded_store(spark, sf_dir)
    days = sorted(r[0] for r in store.ticks().select("trading_day").distinct().collect())
    third = -(-len(days) // 3)
    for at in range(0, len(days), third):
        commands.build_micro_tables(store, P, NOW, days[at : at + third])
    return commands.micro_table(store, "events").select(*COLUMNS.split(", "))


COOLDOWN_SEC = 14_400  # hourly buckets need a cooldown of hours to have an effect

COOLED_SQL = (
    BASE.replace("WITH ", "WITH RECURSIVE ", 1)
    + ALL_SQL.rstrip()
    + f""",
num AS (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY ts_ms) AS i FROM all_events),
fold AS (
SELECT dedup_key, i, ts_ms, ts_ms AS last_sent, 0 AS dropped, TRUE AS emit, 0 AS n FROM num WHERE i = 1
UNION ALL
SELECT n.dedup_key, n.i, n.ts_ms,
  CASE WHEN n.ts_ms - f.last_sent >= {COOLDOWN_SEC * 1000} THEN n.ts_ms ELSE f.last_sent END,
  CASE WHEN n.ts_ms - f.last_sent >= {COOLDOWN_SEC * 1000} THEN 0 ELSE f.dropped + 1 END,
  n.ts_ms - f.last_sent >= {COOLDOWN_SEC * 1000}, f.dropped
FROM fold f JOIN num n ON n.dedup_key = f.dedup_key AND n.i = f.i + 1)
SELECT dedup_key, ts_ms, n AS suppressed_count FROM fold WHERE emit"""
)


@query("k22_cooldown", COOLED_SQL)
def k22_cooldown(spark, sf_dir):
    found = _events(spark, sf_dir).withColumn("cooldown_sec", F.lit(COOLDOWN_SEC))
    return events.apply_cooldown(found).select("dedup_key", "ts_ms", "suppressed_count")


@query(
    "k23_push_policy",
    BASE
    + ALL_SQL
    + f"""SELECT {COLUMNS} FROM all_events WHERE severity = 'ALERT' OR (severity = 'WARN' AND (
  (event_type LIKE 'ABSORPTION%' AND score >= 75) OR (event_type = 'VALUE_REJECTION' AND score >= 70)
  OR event_type = 'OPEN_IMBALANCE'))""",
)
def k23_push_policy(spark, sf_dir):
    return events.pushed(_events(spark, sf_dir)).drop("payload_json", "created_at_ms", "trading_day")


@query(
    "k24_latest_events",
    BASE
    + ALL_SQL
    + f"""SELECT {COLUMNS} FROM all_events WHERE symbol = 'HK.click'
ORDER BY ts_ms DESC, event_type, dedup_key LIMIT 50""",
)
def k24_latest_events(spark, sf_dir):
    found = events.latest_events(_events(spark, sf_dir), "HK.click")
    return found.drop("payload_json", "created_at_ms", "trading_day")


@query(
    "k24_event_counts",
    BASE
    + ALL_SQL
    + f"""SELECT event_type, severity, count(*) AS n FROM all_events WHERE ts_ms >= {NOW} - 86400000
GROUP BY 1, 2""",
)
def k24_event_counts(spark, sf_dir):
    return events.event_counts(_events(spark, sf_dir), NOW)


@query(
    "k24_latest_features",
    q.w(q.EV, TRADES, FEAT)
    + """SELECT ts_min_ms, volume, close FROM feat WHERE symbol = 'HK.error'
ORDER BY ts_min_ms DESC LIMIT 120""",
)
def k24_latest_features(spark, sf_dir):
    return features.latest_features(_features(spark, sf_dir), "HK.error").select(
        "ts_min_ms", "volume", "close"
    )


@query(
    "k24_event_payloads",
    BASE
    + """SELECT ts_min_ms AS ts_ms, symbol, round(impact, 6) AS impact, round(impact_init, 6) AS impact_gate,
  round(abs_return, 6) AS abs_return, in_value_area, coalesce(n_cross, 0) > 0 AS crossed_lvn
FROM ctx LEFT JOIN anycross USING (symbol, ts_min_ms) WHERE initiation""",
)
def k24_event_payloads(spark, sf_dir):
    """The evidence read back from the payload of initiations."""
    found = _events(spark, sf_dir).where(F.col("event_type").startswith("INITIATION"))
    schema = (
        "impact double, impact_gate double, abs_return double, in_value_area int, "
        "crossed_lvn boolean"
    )
    read = found.select("ts_ms", "symbol", F.from_json("payload_json", schema).alias("p"))
    return _rounded(read.select("ts_ms", "symbol", "p.*"), 6, "impact", "impact_gate", "abs_return")


@query(
    "d10_level_crossings",
    BASE
    + """SELECT symbol, trading_day, ts_min_ms, prev_close, close, lvn AS lvn_price,
  CASE WHEN prev_close < lvn THEN 'up' ELSE 'down' END AS direction FROM cross0""",
)
def d10_level_crossings(spark, sf_dir):
    return events.level_crossings(_features(spark, sf_dir), _levels(spark, sf_dir))


@query(
    "d11_latest_compression",
    BASE
    + """SELECT l.symbol, l.trading_day, l.ts_min_ms, max(e.ts_min_ms) AS matched_ts_ms
FROM ctx l JOIN ctx e ON e.symbol = l.symbol AND e.trading_day = l.trading_day
  AND e.compressed AND l.ts_min_ms - e.ts_min_ms > 0 AND l.ts_min_ms - e.ts_min_ms <= 21600000
WHERE l.initiation GROUP BY 1, 2, 3""",
)
def d11_latest_compression(spark, sf_dir):
    """Initiations with the newest compression of the six hours before."""
    ctx = events.with_context(_gated(spark, sf_dir), P)
    keys = ["symbol", "trading_day", "ts_min_ms"]
    later = ctx.where("initiation").select(*keys)
    earlier = ctx.where("compressed").select(*keys)
    return events.latest_before(later, earlier, 21_600_000, time="ts_min_ms")
