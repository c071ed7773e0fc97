"""Feed normalisation, day tables, dedupe, exports, archive."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import archive, dedupe, export, gaps, quality, stats
from ..schema import GAPS
from ..session import shared_folder
from ..sources import calendar, derived, feed
from ..sources.store import TickStore, row_sums
from . import sqltext as q
from .catalog import query

RAW_SQL = f"""raw AS (
SELECT event_id, user_id, (epoch_us(ts) // 1000) AS t0, event_id % 8 AS kind, event_type, value FROM events),
typed AS (
SELECT event_id,
  CASE WHEN user_id = 13 THEN NULL ELSE 'HK.' || event_type END AS symbol,
  CASE WHEN user_id = 77 THEN NULL WHEN user_id = 99 THEN t0
    WHEN kind IN (1, 2, 3, 5) THEN t0 - t0 % 1000 ELSE t0 END AS ts_ms,
  CASE WHEN kind IN (2, 7) THEN {q.day("t0")} END AS given_day,
  CASE WHEN event_id % 77 <> 0 THEN value END AS price,
  CASE WHEN event_id % 50 <> 1 THEN 1 + user_id % 100 END AS volume,
  value * 2 AS turnover,
  CASE WHEN event_id % 5 <> 0 THEN 'BUY' END AS direction,
  CASE WHEN event_id % 3 <> 0 THEN event_id WHEN event_id % 7 <> 0 THEN event_id END AS seq
FROM raw)"""


def _normalized(spark, sf_dir):
    return feed.normalize(
        derived.raw_feed(spark, sf_dir),
        recv_ts_ms=F.col("recv_ts_ms"),
        push_type="push",
        keep=("event_id",),
    )


@query(
    "a1_normalize_feed",
    q.w(RAW_SQL)
    + f"""SELECT event_id, 'HK' AS market, symbol, ts_ms, price, volume, turnover, direction, seq,
  'AUTO_MATCH' AS tick_type, 'push' AS push_type,
  coalesce(given_day, {q.day("ts_ms")}) AS trading_day
FROM typed WHERE symbol IS NOT NULL AND ts_ms IS NOT NULL""",
)
def a1_normalize_feed(spark, sf_dir):
    return feed.accepted(_normalized(spark, sf_dir)).drop(
        "provider", "recv_ts_ms", "inserted_at_ms"
    )


@query(
    "c5_feed_rejects",
    q.w(RAW_SQL)
    + """SELECT CASE WHEN symbol IS NULL THEN 'missing_code' ELSE 'bad_time' END AS reject_reason,
  count(*) AS n FROM typed WHERE symbol IS NULL OR ts_ms IS NULL GROUP BY 1""",
)
def c5_feed_rejects(spark, sf_dir):
    bad = feed.rejects(_normalized(spark, sf_dir))
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def _loaded_store(spark, sf_dir) -> TickStore:
    """The event ticks in a new day-partitioned table."""
    store = TickStore(spark, shared_folder(spark, "store"))
    store.append_ticks(derived.event_ticks(spark, sf_dir))
    return store


@query(
    "a2_day_scan",
    q.w(q.EV)
    + """SELECT symbol, ts_ms, price, volume, seq, trading_day FROM ev
WHERE trading_day = '20240115'""",
)
def a2_day_scan(spark, sf_dir):
    return _loaded_store(spark, sf_dir).ticks(["20240115"]).select(
        "symbol", "ts_ms", "price", "volume", "seq", "trading_day"
    )


@query(
    "a3_append_ticks",
    q.w(q.RESENT, q.KEPT)
    + f"""SELECT trading_day, count(*) AS rows, count(seq) AS with_seq, min(recv_ts_ms) AS first_recv,
  max(recv_ts_ms) AS last_recv
FROM (SELECT trading_day, seq, recv_ts_ms FROM kept
  UNION ALL SELECT trading_day, seq, recv_ts_ms FROM ev0 WHERE {q.ALONE}) GROUP BY 1""",
)
def a3_append_ticks(spark, sf_dir):
    """Two loads: the ticks, then all of them again with the re-sent copies. Only rows that never
    count as duplicates come in a second time."""
    store = _loaded_store(spark, sf_dir)
    store.append_ticks(derived.event_ticks(spark, sf_dir, resent=True))
    return store.ticks().groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("seq").alias("with_seq"),
        F.min("recv_ts_ms").alias("first_recv"),
        F.max("recv_ts_ms").alias("last_recv"),
    )


@query(
    "a4_split_by_day",
    q.w(q.EV)
    + "SELECT trading_day, count(*) AS rows, count(DISTINCT symbol) AS symbols FROM ev GROUP BY 1",
)
def a4_split_by_day(spark, sf_dir):
    return (
        _loaded_store(spark, sf_dir)
        .ticks()
        .groupBy("trading_day")
        .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("symbol").alias("symbols"))
    )


def _gaps(spark, sf_dir):
    return gaps.hard_gaps(
        derived.event_ticks(spark, sf_dir), derived.SPARSE_QUALITY, derived.NOW_MS
    )


@query(
    "a5_gaps_sink",
    q.w(q.EV, q.POINTS, q.GAPS)
    + """SELECT trading_day, symbol, count(*) AS gaps, sum(gap_ms)::BIGINT AS gap_ms
FROM gaps GROUP BY ALL""",
)
def a5_gaps_sink(spark, sf_dir):
    """Gaps stored twice; the second time adds nothing."""
    store = TickStore(spark, shared_folder(spark, "store"))
    found = _gaps(spark, sf_dir)
    store.append_gaps(found)
    store.append_gaps(found)
    return store.gaps().groupBy("trading_day", "symbol").agg(
        F.count(F.lit(1)).alias("gaps"),
        F.sum(F.round(F.col("gap_sec") * 1000).cast("bigint")).alias("gap_ms"),
    )


@query(
    "a8_gaps_csv",
    q.w(q.EV, q.POINTS, q.GAPS)
    + f"""SELECT trading_day, symbol, gap_start_ts_ms, gap_end_ts_ms, gap_sec::DOUBLE AS gap_sec,
  1706659200000::BIGINT AS detected_at_ms, 'hard_gap' AS reason FROM gaps""",
)
def a8_gaps_csv(spark, sf_dir):
    """The CSV read back, without the evidence text."""
    path = shared_folder(spark, "gaps-csv")
    export.export_gaps(_gaps(spark, sf_dir), path)

    return spark.read.schema(GAPS).option("header", True).option("escape", '"').csv(path).drop(
        "meta_json"
    )


VENDOR_SQL = f"""symbol AS code, '' AS name, {q.clock("ts_ms")} AS time, price, volume, turnover,
  direction AS ticker_direction, seq AS sequence, tick_type AS type"""


@query("a9_vendor_rows", q.w(q.EV) + f"SELECT {VENDOR_SQL} FROM ev")
def a9_vendor_rows(spark, sf_dir):
    return export.vendor_rows(derived.event_ticks(spark, sf_dir))


@query(
    "a10_vendor_csv_all_days",
    q.w(q.EV)
    + f"""SELECT trading_day, symbol AS file, {VENDOR_SQL.replace("'' AS name", "NULL::VARCHAR AS name")}
FROM ev""",
)
def a10_vendor_csv_all_days(spark, sf_dir):
    """Every day and symbol exported in one job and read back from the folders."""
    path = shared_folder(spark, "vendor-csv")
    export.export_vendor_csv(derived.event_ticks(spark, sf_dir), path)
    ddl = (
        "code string, name string, time string, price double, volume bigint, turnover double, "
        "ticker_direction string, sequence bigint, type string, trading_day string, file string"
    )
    return spark.read.schema(ddl).option("header", True).csv(path)


def _archived(spark, sf_dir):
    store = _loaded_store(spark, sf_dir)
    store.append_gaps(_gaps(spark, sf_dir))
    root = shared_folder(spark, "archive")
    archive.archive_days(store, root, derived.SPARSE_QUALITY, derived.NOW_MS)
    return store, root


@query(
    "a11_archive_manifest",
    q.w(q.EV, q.POINTS, q.GAPS)
    + """, g AS (SELECT trading_day, count(*) AS n FROM gaps GROUP BY 1)
SELECT trading_day, count(*) AS ticks_count, min(ts_ms) AS start_ts_ms, max(ts_ms) AS end_ts_ms,
  TRUE AS verify_ok, 'zstd' AS compression, coalesce(any_value(g.n), 0) AS hard_gaps_total
FROM ev LEFT JOIN g USING (trading_day) GROUP BY 1""",
)
def a11_archive_manifest(spark, sf_dir):
    store, _ = _archived(spark, sf_dir)
    return store.manifest().select(
        "trading_day", "ticks_count", "start_ts_ms", "end_ts_ms", "verify_ok", "compression",
        "hard_gaps_total",
    )


@query(
    "a12_verify_archive",
    q.w(q.EV)
    + """SELECT trading_day, count(*) AS ticks_count, max(ts_ms) AS max_ts_ms, TRUE AS verify_ok
FROM ev GROUP BY 1""",
)
def a12_verify_archive(spark, sf_dir):
    store, root = _archived(spark, sf_dir)
    return archive.verify(store.ticks(), archive.archived_ticks(spark, root)).select(
        "trading_day", "ticks_count", "max_ts_ms", "verify_ok"
    )


@query(
    "a13_file_checksums",
    q.w(q.EV)
    + """SELECT DISTINCT trading_day, TRUE AS has_files, TRUE AS has_bytes, TRUE AS checksum_ok,
  TRUE AS in_manifest FROM ev""",
)
def a13_file_checksums(spark, sf_dir):
    """Files of each archived day against their recorded checksums, and against the manifest."""
    store, root = _archived(spark, sf_dir)
    files = archive.verify_checksums(spark, root).groupBy("trading_day").agg(
        (F.count(F.lit(1)) > 0).alias("has_files"),
        (F.min("bytes") > 0).alias("has_bytes"),
        F.bool_and("checksum_ok").alias("checksum_ok"),
        F.sum("bytes").alias("_bytes"),
    )
    known = store.manifest().select("trading_day", "archive_bytes", "archive_sha256")
    same = (F.col("archive_bytes") == F.col("_bytes")) & (F.length("archive_sha256") == 64)
    return files.join(known, "trading_day", "left").select(
        "trading_day", "has_files", "has_bytes", "checksum_ok", same.alias("in_manifest")
    )


@query(
    "a14_retention_selection",
    q.w(q.EV)
    + """SELECT trading_day FROM (SELECT trading_day, row_number() OVER (ORDER BY trading_day DESC) AS rn
  FROM (SELECT DISTINCT trading_day FROM ev)) WHERE rn > 14""",
)
def a14_retention_selection(spark, sf_dir):
    """Days beyond the newest 14 whose archive is verified."""
    store, _ = _archived(spark, sf_dir)
    return archive.expired_days(store.ticks(), store.manifest(), keep_days=14)


@query(
    "a14_retention_after_late_rows",
    q.w(q.EV)
    + """SELECT trading_day FROM (SELECT trading_day, row_number() OVER (ORDER BY trading_day DESC) AS rn
  FROM (SELECT DISTINCT trading_day FROM ev)) WHERE rn > 3 AND trading_day::INTEGER % 2 = 0""",
)
def a14_retention_after_late_rows(spark, sf_dir):
    """Days of odd names get rows after they were archived, and are not retired any more."""
    store, root = _archived(spark, sf_dir)
    late = derived.event_ticks(spark, sf_dir).where("CAST(trading_day AS INT) % 2 = 1 AND seq IS NOT NULL")
    late = late.withColumn("seq", F.col("seq") + 10_000_000)
    store.append_ticks(late)
    return archive.expired_days(store.ticks(), store.manifest(), keep_days=3, root=root)


@query(
    "a14_retention_from_fingerprints",
    q.w(q.EV)
    + """, n AS (SELECT trading_day, row_number() OVER (ORDER BY trading_day DESC) AS rn
  FROM (SELECT DISTINCT trading_day FROM ev))
SELECT trading_day FROM n WHERE rn > 5 AND trading_day::INTEGER % 3 <> 0""",
)
def a14_retention_from_fingerprints(spark, sf_dir):
    """Retention by names and kept fingerprints, after some days got rows in new files."""
    store, root = _archived(spark, sf_dir)
    late = derived.event_ticks(spark, sf_dir).where("CAST(trading_day AS INT) % 3 = 0 AND seq IS NOT NULL")
    store.append_ticks(late.withColumn("seq", F.col("seq") + 10_000_000))
    return archive.expired_stored_days(store, root, keep_days=5)


@query(
    "a14_fingerprints_by_file",
    q.w(q.EV) + "SELECT trading_day, count(*) AS ticks_count, max(ts_ms) AS max_ts_ms, TRUE AS same FROM ev GROUP BY 1",
)
def a14_fingerprints_by_file(spark, sf_dir):
    """Fingerprints added up from files, of days that came in two goes and were rewritten in one file
    between: equal to those of the rows."""
    ticks = derived.event_ticks(spark, sf_dir)
    store = TickStore(spark, shared_folder(spark, "store"))
    store.append_ticks(ticks.where("ingest_ordinal % 4 = 0"))
    store.day_prints()
    days = sorted(r[0] for r in store.ticks().select("trading_day").distinct().collect())
    store.compact_days(days[::2])
    store.append_ticks(ticks.where("ingest_ordinal % 4 <> 0"))
    whole = row_sums(store.ticks(), "trading_day").select("trading_day", F.col("row_hashes").cast("string").alias("whole"))
    found = store.day_prints().join(whole, "trading_day")
    return found.select("trading_day", "ticks_count", "max_ts_ms", (F.col("content_hash") == F.col("whole")).alias("same"))


@query(
    "d8_verified_days",
    q.w(q.EV)
    + """SELECT DISTINCT trading_day FROM ev WHERE trading_day IN (
  SELECT trading_day FROM ev GROUP BY 1 HAVING count(*) > 5)""",
)
def d8_verified_days(spark, sf_dir):
    """Semi join of the days with a manifest; a day counts as verified above five rows here."""
    ticks = derived.event_ticks(spark, sf_dir)
    per_day = stats.day_stats(ticks)
    manifest = per_day.select("trading_day", (F.col("total_rows") > 5).alias("verify_ok"))
    return archive.verified_days(ticks.select("trading_day").distinct(), manifest)


@query(
    "a15_recent_days",
    q.w(q.EV)
    + "SELECT DISTINCT trading_day FROM ev ORDER BY trading_day DESC LIMIT 3",
)
def a15_recent_days(spark, sf_dir):
    return stats.recent_days(derived.event_ticks(spark, sf_dir), 3)


def _holiday_lines(spark, sf_dir):
    orders = derived.table(spark, sf_dir, "orders")
    stamp = F.col("o_orderdate")
    line = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(stamp, "yyyy-MM-dd"))
        .when(
            F.col("o_orderpriority") == "2-HIGH",
            F.concat(F.lit("  "), F.date_format(stamp, "yyyyMMdd"), F.lit(" ,closed")),
        )
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("# "), stamp.cast("string")))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format(stamp, "yyyy/M/d"))
        .otherwise("")
    )
    return orders.select(line.alias("value"))


HOLIDAY_SQL = """lines AS (
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN '2-HIGH' THEN '  ' || strftime(o_orderdate, '%Y%m%d') || ' ,closed'
  WHEN '3-MEDIUM' THEN '# x'
  WHEN '5-LOW' THEN year(o_orderdate) || '/' || month(o_orderdate) || '/' || day(o_orderdate)
  ELSE '' END AS value FROM orders),
holidays AS (SELECT DISTINCT d AS trading_day FROM (
  SELECT regexp_replace(trim(split_part(trim(value), ',', 1)), '[-/]', '', 'g') AS d FROM lines
  WHERE trim(value) <> '' AND NOT starts_with(trim(value), '#'))
  WHERE regexp_matches(d, '^[0-9]{8}$'))"""


@query("a16_holiday_file", q.w(HOLIDAY_SQL) + "SELECT trading_day FROM holidays")
def a16_holiday_file(spark, sf_dir):
    path = shared_folder(spark, "holidays")
    _holiday_lines(spark, sf_dir).write.text(path)
    return calendar.read_holidays(spark, path)


@query(
    "h1_holiday_union",
    q.w(HOLIDAY_SQL)
    + """SELECT trading_day FROM holidays UNION SELECT '20240101' UNION SELECT '20240210'""",
)
def h1_holiday_union(spark, sf_dir):
    listed = calendar.parse_holidays(_holiday_lines(spark, sf_dir))
    return calendar.merge_holidays(listed, ["2024-01-01", "20240210", "bad"])


@query(
    "h2_recent_day_union",
    q.w(q.EV)
    + """SELECT '20240131' AS trading_day UNION
SELECT * FROM (SELECT DISTINCT trading_day FROM ev ORDER BY 1 DESC LIMIT 3)""",
)
def h2_recent_day_union(spark, sf_dir):
    days = stats.recent_days(derived.event_ticks(spark, sf_dir), 3)
    today = quality.requested_days(spark, ["20240131"])
    return today.union(days).distinct()


@query(
    "h3_union_origins",
    q.w(q.EV) + "SELECT push_type, count(*) AS rows, max(ts_ms) AS max_ts_ms FROM ev GROUP BY 1",
)
def h3_union_origins(spark, sf_dir):
    ticks = derived.event_ticks(spark, sf_dir)
    parts = [ticks.where(F.col("push_type") == p) for p in ("push", "poll", "backfill")]
    return (
        feed.union_origins(*parts)
        .groupBy("push_type")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("ts_ms").alias("max_ts_ms"))
    )


@query(
    "h4_keys_not_stored",
    q.w(q.EV)
    + """SELECT symbol, seq FROM ev WHERE seq IS NOT NULL AND (symbol, seq) NOT IN (
  SELECT symbol, seq FROM ev WHERE seq IS NOT NULL AND push_type = 'push')""",
)
def h4_keys_not_stored(spark, sf_dir):
    ticks = derived.event_ticks(spark, sf_dir).where("seq IS NOT NULL")
    stored = ticks.where("push_type = 'push'")
    return dedupe.missing_keys(ticks, stored, ["symbol", "seq"]).select("symbol", "seq")


@query(
    "a18_footprint",
    q.w(q.EV)
    + "SELECT DISTINCT trading_day, TRUE AS has_files, TRUE AS has_bytes FROM ev",
)
def a18_footprint(spark, sf_dir):
    from ..sources.store import footprint

    sizes = footprint(spark, _loaded_store(spark, sf_dir).ticks_path)
    return sizes.select(
        "trading_day", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes")
    )


@query(
    "a19_pending_days",
    q.w(q.EV)
    + """SELECT DISTINCT trading_day FROM ev WHERE trading_day NOT IN (
  SELECT trading_day FROM ev WHERE price > 250)""",
)
def a19_pending_days(spark, sf_dir):
    """Days not converted yet; a price above 250 marks a day as done here."""
    ticks = derived.event_ticks(spark, sf_dir)
    done = ticks.where("price > 250").select("trading_day").distinct()
    return archive.pending_days(ticks.select("trading_day").distinct(), done)


KEPT_COLUMNS = """trading_day, symbol, seq, ts_ms, price, volume, turnover, push_type, recv_ts_ms"""


@query(
    "d1_dedupe_ticks",
    q.w(q.RESENT, q.KEPT) + f"SELECT {KEPT_COLUMNS} FROM kept",
)
def d1_dedupe_ticks(spark, sf_dir):
    ticks = derived.event_ticks(spark, sf_dir, resent=True)
    return dedupe.dedupe_ticks(ticks).select(*KEPT_COLUMNS.split(", "))


@query(
    "d1_dedupe_lineitem",
    q.w(q.LI)
    + """SELECT symbol, seq, ts_ms, price, volume, turnover FROM (SELECT *, row_number() OVER (
  PARTITION BY trading_day, symbol, seq ORDER BY recv_ts_ms, l_partkey, price, volume, turnover,
  l_discount, l_tax, l_linestatus) AS rn FROM li) WHERE rn = 1""",
)
def d1_dedupe_lineitem(spark, sf_dir):
    ticks = derived.lineitem_ticks(spark, sf_dir)
    return dedupe.dedupe_ticks(ticks, derived.LINEITEM_ARRIVAL).select(
        "symbol", "seq", "ts_ms", "price", "volume", "turnover"
    )


@query(
    "d2_dedupe_accounting",
    q.w(q.RESENT, q.KEPT)
    + """SELECT trading_day, any_value(b.batch) AS batch, count(*) AS inserted,
  any_value(b.batch) - count(*) AS ignored
FROM kept JOIN (SELECT trading_day, count(*) AS batch FROM ev GROUP BY 1) b USING (trading_day)
GROUP BY 1""",
)
def d2_dedupe_accounting(spark, sf_dir):
    return dedupe.dedupe_counts(derived.event_ticks(spark, sf_dir, resent=True))


def _poll(spark, sf_dir):
    """Polled rows against the highest pushed seq with a price above 50."""
    ticks = derived.event_ticks(spark, sf_dir, resent=True)
    baseline = dedupe.max_seq_by_symbol(ticks.where("push_type = 'push' AND price > 150"))
    known = ticks.where("push_type = 'backfill'")
    return dedupe.flag_polled(ticks.where("push_type = 'poll'"), baseline, known)


POLL_SQL = """polled AS (SELECT * FROM ev WHERE push_type = 'poll'),
base AS (SELECT symbol, max(seq) AS base FROM ev WHERE push_type = 'push' AND price > 150
  GROUP BY 1),
known AS (SELECT DISTINCT symbol, ts_ms, price, volume, turnover FROM ev
  WHERE push_type = 'backfill'),
flagged AS (SELECT p.*, b.base, k.symbol IS NOT NULL AND p.seq IS NULL AS known_key
  FROM polled p LEFT JOIN base b USING (symbol)
  LEFT JOIN known k ON p.symbol = k.symbol AND p.ts_ms = k.ts_ms
    AND p.price IS NOT DISTINCT FROM k.price AND p.volume = k.volume
    AND p.turnover IS NOT DISTINCT FROM k.turnover),
ranked AS (SELECT *, coalesce(seq <= base, FALSE) OR known_key AS old,
  row_number() OVER (PARTITION BY symbol, seq, CASE WHEN seq IS NULL THEN ts_ms END,
    CASE WHEN seq IS NULL THEN price END, CASE WHEN seq IS NULL THEN volume END,
    CASE WHEN seq IS NULL THEN turnover END, coalesce(seq <= base, FALSE) OR known_key
    ORDER BY recv_ts_ms, ingest_ordinal) AS rn FROM flagged)"""


@query(
    "d3_poll_baseline",
    q.w(q.RESENT, POLL_SQL)
    + """SELECT symbol, ts_ms, seq, recv_ts_ms, CASE WHEN old OR rn > 1 THEN 'duplicate' ELSE 'kept'
  END AS outcome FROM ranked""",
)
def d3_poll_baseline(spark, sf_dir):
    return _poll(spark, sf_dir).select("symbol", "ts_ms", "seq", "recv_ts_ms", "outcome")


@query(
    "d3_poll_counts",
    q.w(q.RESENT, POLL_SQL)
    + """SELECT symbol, count(*) FILTER (NOT (old OR rn > 1)) AS kept,
  count(*) FILTER (old OR rn > 1) AS dropped_duplicate, 0::BIGINT AS dropped_filter
FROM ranked GROUP BY 1""",
)
def d3_poll_counts(spark, sf_dir):
    return dedupe.poll_counts(_poll(spark, sf_dir))


@query(
    "d4_recent_keys",
    q.w(q.RESENT)
    + """SELECT symbol, ts_ms, price, volume, turnover, recv_ts_ms FROM ev e WHERE seq IS NULL
  AND push_type = 'poll' AND NOT EXISTS (SELECT 1 FROM ev s WHERE s.seq IS NULL
    AND s.push_type <> 'poll' AND s.symbol = e.symbol AND s.ts_ms = e.ts_ms
    AND s.price IS NOT DISTINCT FROM e.price AND s.volume IS NOT DISTINCT FROM e.volume
    AND s.turnover IS NOT DISTINCT FROM e.turnover)""",
)
def d4_recent_keys(spark, sf_dir):
    """Seq-less polled rows whose key no push or backfill has brought; missing parts are equal."""
    seqless = derived.event_ticks(spark, sf_dir, resent=True).where("seq IS NULL")
    known = seqless.where("push_type <> 'poll'")
    keys = ["symbol", "ts_ms", "price", "volume", "turnover"]
    return dedupe.missing_keys(seqless.where("push_type = 'poll'"), known, keys).select(
        *keys, "recv_ts_ms"
    )


@query(
    "d5_dedupe_gaps",
    q.w(q.EV, q.POINTS, q.GAPS)
    + """SELECT symbol, gap_start_ts_ms, gap_end_ts_ms, 1706659200000::BIGINT AS detected_at_ms
FROM gaps""",
)
def d5_dedupe_gaps(spark, sf_dir):
    """The same gaps found twice, at two times."""
    found = _gaps(spark, sf_dir)
    later = found.withColumn("detected_at_ms", F.col("detected_at_ms") + 60_000)
    return dedupe.dedupe_gaps(found.unionByName(later)).select(
        "symbol", "gap_start_ts_ms", "gap_end_ts_ms", "detected_at_ms"
    )


@query(
    "d6_holiday_lookup",
    q.w(q.EV, HOLIDAY_SQL)
    + """, d AS (SELECT trading_day, count(*) AS rows FROM ev GROUP BY 1)
SELECT d.trading_day, rows, EXISTS (SELECT 1 FROM holidays h
  WHERE substr(h.trading_day, 5) = substr(d.trading_day, 5)) AS is_holiday FROM d""",
)
def d6_holiday_lookup(spark, sf_dir):
    """Days against a holiday list matched by month and day."""
    days = derived.event_ticks(spark, sf_dir).groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("rows")
    )
    listed = calendar.parse_holidays(_holiday_lines(spark, sf_dir))
    # the list names days of other years
    shifted = listed.select(F.concat(F.lit("2024"), F.substr("trading_day", F.lit(5))).alias("trading_day"))
    return calendar.with_holidays(days, "trading_day", shifted)


def _seen_and_persisted(spark, sf_dir):
    ticks = derived.event_ticks(spark, sf_dir)
    seen = dedupe.max_seq_by_symbol(ticks.where("push_type <> 'backfill' AND symbol <> 'HK.view'"))
    persisted = dedupe.max_seq_by_symbol(ticks.where("price < 2 AND symbol <> 'HK.click'"))
    return dedupe.seq_lag(seen, persisted)


LAG_SQL = """lags AS (
SELECT s.symbol, s.m AS seen_seq, p.m AS persisted_seq, greatest(0, s.m - coalesce(p.m, 0)) AS seq_lag
FROM (SELECT symbol, max(seq) AS m FROM ev WHERE push_type <> 'backfill' AND symbol <> 'HK.view'
  AND seq IS NOT NULL GROUP BY 1) s
LEFT JOIN (SELECT symbol, max(seq) AS m FROM ev WHERE price < 2 AND symbol <> 'HK.click'
  AND seq IS NOT NULL GROUP BY 1) p USING (symbol))"""


@query("d7_seen_persisted", q.w(q.EV, LAG_SQL) + "SELECT * FROM lags")
def d7_seen_persisted(spark, sf_dir):
    return _seen_and_persisted(spark, sf_dir)


@query("e13_max_seq_lag", q.w(q.EV, LAG_SQL) + "SELECT max(seq_lag) AS max_seq_lag FROM lags")
def e13_max_seq_lag(spark, sf_dir):
    return _seen_and_persisted(spark, sf_dir).agg(F.max("seq_lag").alias("max_seq_lag"))


@query(
    "b16_file_stem",
    """SELECT p_name AS symbol, CASE WHEN stem = '' THEN 'UNKNOWN' ELSE stem END AS stem FROM (
SELECT p_name, regexp_replace(regexp_replace(p_name, '[^A-Za-z0-9._-]+', '_', 'g'),
  '^[._]+|[._]+$', '', 'g') AS stem FROM part)""",
)
def b16_file_stem(spark, sf_dir):
    part = derived.table(spark, sf_dir, "part")
    return part.select(F.col("p_name").alias("symbol"), text.file_stem("p_name").alias("stem"))


