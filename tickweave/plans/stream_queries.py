"""Streams run to completion over the tables, so their results can be compared."""

from __future__ import annotations


from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..operators import folds
from ..session import path_exists, shared_folder
from ..sources import derived
from ..sources.rows_source import stream_rows
from ..sources.store import TickStore, footprint
from ..streaming import decision_stream, feature_stream, gap_slices, gap_stream, ingest
from . import sqltext as q
from .catalog import CHECKS, query
from .health_queries import DEDUPE_SQL, P as HEALTH_PARAMS
from .micro_queries import (
    COOLDOWN_SEC,
    COOLED_SQL,
    FEAT,
    FEATURE_ROWS,
    P as MICRO_PARAMS,
    TRADES,
    _events,
    _rounded,
)

GAP_PARAMS = derived.SPARSE_QUALITY


def _landed(spark, df, name, order, parts=3):
    """A landing folder per arrival step, filled by range of the arrival column, and a stream that takes
    one step's files at a time."""
    path = shared_folder(spark, name)
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    step = (hi - lo) // parts + 1
    for i in range(parts):
        rows = df.where(
            (F.col(order) >= lo + i * step) & (F.col(order) < lo + (i + 1) * step)
        )
        # no number of partitions: the planner's own width, merged by size
        rows.repartitionByRange(order).write.mode("append").parquet(f"{path}/step={i}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = files.option("pathGlobFilter", "*.parquet").load(path)
    most = files.groupBy(F.regexp_extract("path", r"step=(\d+)", 1)).count().agg(F.max("count")).first()[0]
    reader = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", most).parquet(path)


def _finish(writer_query):
    writer_query.awaitTermination()


def _collected(spark, stream, name, mode="append"):
    """The stream's output as a table of files."""
    out, check = shared_folder(spark, name), shared_folder(spark, "checkpoint")
    _finish(
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", check)
        .trigger(availableNow=True)
        .start(out)
    )
    return spark.read.schema(stream.schema).parquet(out)


@query(
    "i2_stream_load",
    q.w(q.RESENT, q.KEPT)
    + """SELECT trading_day, count(*) AS rows, count(seq) AS with_seq, sum(volume)::BIGINT AS volume
FROM kept GROUP BY 1""",
)
def i2_stream_load(spark, sf_dir):
    """Ticks with re-sent copies streamed into the day table."""
    ingest.streaming_session(spark)
    ticks = derived.event_ticks(spark, sf_dir, resent=True)
    stream = _landed(spark, ticks, "landing", "recv_ts_ms")
    store = TickStore(spark, shared_folder(spark, "store"))
    _finish(ingest.load_ticks(stream, store, shared_folder(spark, "checkpoint"), wait=None))
    return store.ticks().groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("seq").alias("with_seq"),
        F.sum("volume").alias("volume"),
    )


@query(
    "i2_replayed_batch",
    q.w(q.EV)
    + """SELECT trading_day, count(*) AS rows, count(seq) AS with_seq, sum(volume)::BIGINT AS volume
FROM ev GROUP BY 1""",
)
def i2_replayed_batch(spark, sf_dir):
    """A micro-batch loaded again under its epoch, after it was done and after it was lost behind its write,
    adds nothing, rows without an identity of their own included."""
    ticks = derived.event_ticks(spark, sf_dir)
    root = shared_folder(spark, "store")
    store = TickStore(spark, root)
    store.append_ticks(ticks.where("ingest_ordinal % 4 < 2"), load="a", epoch=0)
    try:
        LostOnce(spark, root).append_ticks(ticks.where("ingest_ordinal % 4 >= 2"), load="a", epoch=1)
    except Lost:
        store.append_ticks(ticks.where("ingest_ordinal % 4 >= 2"), load="a", epoch=1)
    store.append_ticks(ticks.where("ingest_ordinal % 4 < 2"), load="a", epoch=0)
    store.append_ticks(ticks.where("ingest_ordinal % 4 >= 2"), load="a", epoch=1)
    return store.ticks().groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("seq").alias("with_seq"),
        F.sum("volume").alias("volume"),
    )


class Lost(RuntimeError):
    """The driver's end between a write and its commit."""


class LostOnce(TickStore):
    """A store whose first batch ends behind the write of its ticks, before anything else is written."""

    lost = False

    def _raise_baseline(self, batch):
        if not self.lost:
            self.lost = True
            raise Lost
        super()._raise_baseline(batch)


@query(
    "i2_compacted_days",
    q.w(q.EV)
    + """SELECT trading_day, count(*) AS rows, count(seq) AS with_seq, sum(volume)::BIGINT AS volume,
  TRUE AS fewer_files FROM ev GROUP BY 1""",
)
def i2_compacted_days(spark, sf_dir):
    """Days loaded in many small goes, then rewritten: the same rows in fewer files."""
    ticks = derived.event_ticks(spark, sf_dir)
    store = TickStore(spark, shared_folder(spark, "store"))
    for part in range(3):
        store.append_ticks(ticks.where(F.col("ingest_ordinal") % 3 == part), load="a", epoch=part)
    many = kept_sizes(spark, store)
    days = [r[0] for r in store.ticks().select("trading_day").distinct().collect()]
    store.compact_days(days)
    fewer = footprint(spark, store.ticks_path).join(many, "trading_day")
    rows = store.ticks().groupBy("trading_day").agg(
        F.count(F.lit(1)).alias("rows"), F.count("seq").alias("with_seq"), F.sum("volume").alias("volume")
    )
    less = fewer.select("trading_day", ((F.col("files") == 1) | (F.col("files") < F.col("before"))).alias("fewer_files"))
    return rows.join(less, "trading_day")


def kept_sizes(spark, store):
    """File counts as they are now, as a table of its own."""
    rows = footprint(spark, store.ticks_path).select("trading_day", "files").collect()  # one per day
    return spark.createDataFrame([tuple(r) for r in rows], "trading_day string, before bigint")


@query(
    "i1_paced_load",
    q.w(q.EV) + "SELECT push_type, count(*) AS rows FROM ev GROUP BY 1",
)
def i1_paced_load(spark, sf_dir):
    """Micro-batches limited by files and paced by a processing-time trigger."""
    ingest.streaming_session(spark)
    stream = _landed(spark, derived.event_ticks(spark, sf_dir), "landing", "recv_ts_ms")
    store = TickStore(spark, shared_folder(spark, "store"))
    running = ingest.load_ticks(
        stream, store, shared_folder(spark, "checkpoint"), wait="100 milliseconds"
    )
    running.processAllAvailable()
    running.stop()
    return store.ticks().groupBy("push_type").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "i3_stream_gaps",
    q.w(q.EV, q.POINTS, q.GAPS)
    + """SELECT trading_day, symbol, gap_start_ts_ms, gap_end_ts_ms, gap_sec::DOUBLE AS gap_sec,
  'hard_gap' AS reason FROM gaps""",
)
def i3_stream_gaps(spark, sf_dir):
    """Live gap detection over ordered arrival equals the batch form."""
    ingest.streaming_session(spark)
    stream = _landed(spark, derived.event_ticks(spark, sf_dir), "landing", "ts_ms")
    store = TickStore(spark, shared_folder(spark, "store"))
    _finish(
        ingest.load_gaps(stream, store, GAP_PARAMS, shared_folder(spark, "checkpoint"), wait=None)
    )
    return store.gaps().drop("detected_at_ms", "meta_json")


# the first third as it is; of the later thirds only what lies after every time seen before
LATE_SQL = """, third AS (SELECT *, (ingest_ordinal // 2) % 3 AS step FROM ev0),
m0 AS (SELECT symbol, max(ts_ms) AS m FROM third WHERE step = 0 GROUP BY 1),
m1 AS (SELECT symbol, max(ts_ms) AS m FROM third WHERE step <= 1 GROUP BY 1),
ev AS (SELECT third.* FROM third WHERE step = 0
  UNION ALL SELECT third.* FROM third JOIN m0 USING (symbol) WHERE step = 1 AND ts_ms > m
  UNION ALL SELECT third.* FROM third JOIN m1 USING (symbol) WHERE step = 2 AND ts_ms > m)"""


@query(
    "i5_late_ticks",
    q.w(q.EV.split(",\nev AS (")[0])
    + LATE_SQL
    + ",\n"
    + q.POINTS
    + ",\n"
    + q.GAPS
    + " SELECT symbol, gap_start_ts_ms, gap_end_ts_ms FROM gaps",
)
def i5_late_ticks(spark, sf_dir):
    """Arrival out of time order, every third tick first: late ticks change no gap found before."""
    ingest.streaming_session(spark)
    ticks = derived.event_ticks(spark, sf_dir)
    mixed = ticks.withColumn("step", F.floor(F.col("ingest_ordinal") / 2) % 3)
    stream = _landed(spark, mixed, "landing", "step")
    found = gap_stream.stream_gaps(stream, GAP_PARAMS)
    return _collected(spark, found, "gaps").select("symbol", "gap_start_ts_ms", "gap_end_ts_ms")


@query("i7_stream_features", q.w(q.EV, TRADES, FEAT) + FEATURE_ROWS)
def i7_stream_features(spark, sf_dir):
    """Minute features from a stream equal the batch form, the last buckets included."""
    ingest.streaming_session(spark)
    stream = _landed(spark, derived.event_ticks(spark, sf_dir), "landing", "ts_ms")
    rows = _collected(spark, feature_stream.stream_features(stream, MICRO_PARAMS), "features")
    newest = feature_stream.newest_revisions(rows).drop("revision", "late_ticks", "jump_count")
    out = _rounded(newest, 6, "imbalance", "abs_return", "price_change", "impact")
    return _rounded(out, 2, "turnover")


@query(
    "d4_stream_recent_keys",
    q.w(q.RESENT)
    + """SELECT symbol, ts_ms, price, volume, turnover, count(*) AS rows FROM (
  SELECT DISTINCT symbol, ts_ms, price, volume, turnover FROM ev WHERE seq IS NULL
  UNION ALL SELECT symbol, ts_ms, price, volume, turnover FROM ev WHERE seq IS NOT NULL)
GROUP BY ALL""",
)
def d4_stream_recent_keys(spark, sf_dir):
    """Re-sent seq-less ticks dropped within ten minutes of receive time."""
    ingest.streaming_session(spark)
    ticks = derived.event_ticks(spark, sf_dir, resent=True)
    stream = _landed(spark, ticks, "landing", "recv_ts_ms")
    kept = _collected(spark, ingest.drop_recent_repeats(stream), "kept")
    keys = ["symbol", "ts_ms", "price", "volume", "turnover"]
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "i8_stream_alerts",
    DEDUPE_SQL
    + """SELECT fingerprint, ord, reason, reason <> 'cooldown_active' AS emitted FROM fold WHERE i > 0""",
)
def i8_stream_alerts(spark, sf_dir):
    """Alert decisions on keyed state; incidents run on over days."""
    ingest.streaming_session(spark)
    stream = _landed(spark, derived.alerts(spark, sf_dir), "alerts", "created_at_ms")
    decided = decision_stream.stream_alerts(stream, HEALTH_PARAMS)
    return _collected(spark, decided, "decided").select("fingerprint", "ord", "reason", "emitted")


@query(
    "i8_alerts_over_days",
    DEDUPE_SQL
    + """SELECT fingerprint, ord, reason, reason <> 'cooldown_active' AS emitted FROM fold WHERE i > 0""",
)
def i8_alerts_over_days(spark, sf_dir):
    """The batch form with incidents running on over days."""
    out = folds.alert_decisions(derived.alerts(spark, sf_dir), HEALTH_PARAMS)
    return out.select("fingerprint", "ord", "reason", "emitted")


@query("k22_stream_cooldown", COOLED_SQL)
def k22_stream_cooldown(spark, sf_dir):
    """Event cooldown on keyed state."""
    ingest.streaming_session(spark)
    found = _events(spark, sf_dir).withColumn("cooldown_sec", F.lit(COOLDOWN_SEC))
    stream = _landed(spark, found, "events", "ts_ms")
    kept = decision_stream.stream_cooldown(stream)
    out = _collected(spark, kept, "kept")
    return out.select(
        "dedup_key", "ts_ms", F.col("suppressed_count").cast("int").alias("suppressed_count")
    )




# a day of slack: what lies a day and more behind the largest time seen is late
LATE_MS = 86_400_000
CLOSE_SQL = f"({{}} + {q.HK_MS}) // 86400000 * 86400000 + 86400000 - {q.HK_MS}"


def _closing_features(spark, stream):
    """Output of the minute features on event time, and the checkpoint with the state that is left."""
    out, check = shared_folder(spark, "features"), shared_folder(spark, "checkpoint")
    rows = feature_stream.stream_features(stream, MICRO_PARAMS, late_ms=LATE_MS)
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", check)
    _finish(writer.trigger(availableNow=True).start(out))
    return spark.read.schema(rows.schema).parquet(out), check


@query(
    "i6_watermark_features",
    q.w(q.EV, TRADES, FEAT) + FEATURE_ROWS.replace(" FROM feat", ", jump_count FROM feat"),
)
def i6_watermark_features(spark, sf_dir):
    """Minute features whose state goes with the day: equal to the batch form while rows come in order."""
    ingest.streaming_session(spark)
    stream = _landed(spark, derived.event_ticks(spark, sf_dir), "landing", "ts_ms", parts=6)
    rows, _ = _closing_features(spark, stream)
    newest = feature_stream.newest_revisions(feature_stream.added(rows)).drop("revision", "late_ticks")
    out = _rounded(newest, 6, "imbalance", "abs_return", "price_change", "impact")
    return _rounded(out, 2, "turnover")


@query(
    "i6_open_state",
    q.w(q.EV)
    + f""", seen AS (SELECT *, max(ts_ms) OVER () - {LATE_MS} AS mark FROM ev WHERE price IS NOT NULL)
SELECT symbol, trading_day, count(*) AS ticks FROM seen
GROUP BY symbol, trading_day, mark HAVING {CLOSE_SQL.format("max(ts_ms)")} > mark""",
)
def i6_open_state(spark, sf_dir):
    """What the state store still holds at the end: the days that the watermark has not passed, no more."""
    ingest.streaming_session(spark)
    ticks = derived.event_ticks(spark, sf_dir).where("price IS NOT NULL")
    _, check = _closing_features(spark, _landed(spark, ticks, "landing", "ts_ms", parts=6))
    state = spark.read.format("statestore").option("path", check).option("stateVarName", "features").load()
    held = state.select("key.symbol", "key.trading_day").distinct()
    return ticks.join(held, ["symbol", "trading_day"]).groupBy("symbol", "trading_day").agg(
        F.count(F.lit(1)).alias("ticks")
    )


# every third tick of each day comes first; the watermark of a later step is that of the steps before
LATE_TICKS_SQL = f""", step AS (SELECT *, (ingest_ordinal // 2) % 3 AS step FROM ev WHERE price IS NOT NULL),
mark AS (SELECT step, max(ts_ms) - {LATE_MS} AS mark FROM step GROUP BY 1),
place AS (
  SELECT *, (ts_ms, coalesce(seq, -1), price, volume) AS place,
    {CLOSE_SQL.format("ts_ms")} AS ends FROM step),
days AS (SELECT symbol, trading_day, step, max(place) AS last, max(ends) AS ends FROM place GROUP BY ALL),
late AS (
  SELECT p.symbol, p.trading_day, p.ts_ms, p.seq,
    max(m.mark) AS mark, max(d.last) AS last, max(d.ends) AS day_ends, max(p.ends) AS ends, max(p.place) AS place
  FROM place p LEFT JOIN mark m ON m.step < p.step
  LEFT JOIN days d ON d.symbol = p.symbol AND d.trading_day = p.trading_day AND d.step < p.step
  GROUP BY p.symbol, p.trading_day, p.ts_ms, p.seq, p.ingest_ordinal)
SELECT symbol, trading_day, ts_ms, seq FROM late WHERE ends <= mark OR place < last"""


@query("i6_late_rows", q.w(q.EV) + LATE_TICKS_SQL)
def i6_late_rows(spark, sf_dir):
    """Arrival in three passes over all days: what comes behind a closed day, or behind a later tick of an
    open one, lands in the table of late ticks, and nothing else does."""
    ingest.streaming_session(spark)
    ticks = derived.event_ticks(spark, sf_dir).where("price IS NOT NULL")
    mixed = ticks.withColumn("step", F.floor(F.col("ingest_ordinal") / 2) % 3)
    rows, _ = _closing_features(spark, _landed(spark, mixed, "landing", "step"))
    return feature_stream.late_ticks(rows).select("symbol", "trading_day", "ts_ms", "seq")


# all rows without a seq, so that memory is by key alone; sent again seven seconds and ten days later
FIFO_TICKS = """
t AS (
  SELECT symbol, push_type, ts_ms, price, volume, turnover, recv_ts_ms, ingest_ordinal FROM ev
  UNION ALL
  SELECT symbol, 'poll', ts_ms, price, volume, turnover, recv_ts_ms + 864000000, ingest_ordinal + 100000000
  FROM ev WHERE (ingest_ordinal // 2) % 9 = 0),
n AS (
  SELECT symbol, push_type, concat_ws('|', ts_ms, coalesce(price::VARCHAR, '?'), volume, coalesce(turnover::VARCHAR, '?')) AS key,
    recv_ts_ms, ingest_ordinal, row_number() OVER (PARTITION BY symbol ORDER BY recv_ts_ms, ingest_ordinal) AS i FROM t)"""
FIFO_SQL = """, memory AS (
SELECT symbol, 0::BIGINT AS i, []::VARCHAR[] AS keys, FALSE AS kept, 0::BIGINT AS ingest_ordinal FROM n GROUP BY symbol
UNION ALL
SELECT n.symbol, n.i,
  CASE WHEN list_contains(m.keys, n.key) THEN m.keys
    ELSE list_append(CASE WHEN len(m.keys) >= 500 THEN m.keys[2:] ELSE m.keys END, n.key) END,
  n.push_type <> 'poll' OR NOT list_contains(m.keys, n.key), n.ingest_ordinal
FROM memory m JOIN n ON n.symbol = m.symbol AND n.i = m.i + 1)
SELECT symbol, ingest_ordinal, kept FROM memory WHERE i > 0"""


@query("d4_newest_500_keys", q.w(q.RESENT, FIFO_TICKS).replace("WITH ", "WITH RECURSIVE ", 1) + FIFO_SQL)
def d4_newest_500_keys(spark, sf_dir):
    """Polled ticks against the newest 500 keys of their symbol, first in first out: copies that come soon
    are dropped, and those that come after 500 other keys are not."""
    ingest.streaming_session(spark)
    ticks = derived.event_ticks(spark, sf_dir, resent=True).withColumn("seq", F.lit(None).cast("long"))
    later = {
        "push_type": F.lit("poll"),
        "recv_ts_ms": F.col("recv_ts_ms") + 864_000_000,
        "ingest_ordinal": F.col("ingest_ordinal") + 100_000_000,
    }
    ticks = ticks.unionByName(ticks.where("(ingest_ordinal div 2) % 9 = 0").withColumns(later))
    stream = _landed(spark, ticks, "landing", "recv_ts_ms", parts=4)
    kept = _collected(spark, ingest.drop_remembered(stream), "kept").select("ingest_ordinal", F.lit(True).alias("kept"))
    return ticks.join(kept, "ingest_ordinal", "left").select(
        "symbol", "ingest_ordinal", F.coalesce("kept", F.lit(False)).alias("kept")
    )


@query(
    "i1_rows_per_batch",
    q.w(q.EV) + """SELECT least(500, n - 500 * i)::BIGINT AS rows, count(*) AS batches
FROM (SELECT count(*) AS n FROM ev), range(1000) r(i) WHERE 500 * i < n GROUP BY 1""",
)
def i1_rows_per_batch(spark, sf_dir):
    """Batches of a load that is bounded by 500 rows, broken off once and taken up again."""
    ingest.streaming_session(spark)
    landing, check = shared_folder(spark, "landing"), shared_folder(spark, "checkpoint")
    ticks = derived.event_ticks(spark, sf_dir)
    ticks.repartitionByRange("recv_ts_ms").sortWithinPartitions("recv_ts_ms").write.parquet(landing)
    out = shared_folder(spark, "rows")

    def loaded(batch, epoch):
        if epoch == 3 and not path_exists(spark, f"{out}/epoch=3"):
            batch.limit(7).select("ingest_ordinal").write.parquet(f"{out}/epoch=3")
            raise RuntimeError("lost after a part was written")
        batch.select("ingest_ordinal").write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    for run in range(2):
        rows = stream_rows(spark, landing, ticks.schema, f"{check}/ledger", max_rows=500)
        running = rows.writeStream.foreachBatch(loaded).option("checkpointLocation", f"{check}/query").start()
        try:
            running.processAllAvailable()
        except StreamingQueryException:
            if run:
                raise
        finally:
            running.stop()
    found = spark.read.parquet(out)
    sizes = found.groupBy("epoch").agg(F.countDistinct("ingest_ordinal").alias("rows"))
    return sizes.groupBy("rows").agg(F.count(F.lit(1)).alias("batches"))


@query(
    "i4_lost_between_write_and_commit",
    q.w(q.EV)
    + """SELECT trading_day, symbol, count(*) AS rows, count(seq) AS with_seq, sum(volume)::BIGINT AS volume,
  max(seq) AS max_seq FROM ev GROUP BY 1, 2""",
)
def i4_lost_between_write_and_commit(spark, sf_dir):
    """A stream whose driver is lost after a batch's ticks were written and before the batch was marked, and
    again after it was marked and before Spark committed it: taken up from the checkpoint, the table and the
    highest seqs hold every row once."""
    ingest.streaming_session(spark)
    ticks = derived.event_ticks(spark, sf_dir)
    stream = _landed(spark, ticks, "landing", "recv_ts_ms")
    store, check = LostOnce(spark, shared_folder(spark, "store")), shared_folder(spark, "checkpoint")
    heard = []

    def lost_after_commit(epoch, result):
        heard.append(epoch)
        if heard.count(1) == 1 and epoch == 1:
            raise Lost

    for _ in range(3):
        running = ingest.load_ticks(stream, store, check, wait=None, observer=lost_after_commit)
        try:
            running.awaitTermination()
        except StreamingQueryException:
            pass
    rows = store.ticks().groupBy("trading_day", "symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.count("seq").alias("with_seq"), F.sum("volume").alias("volume")
    )
    return rows.join(store.highest_seqs(), ["trading_day", "symbol"])


@query(
    "i15_persisted_seqs",
    q.w(q.EV)
    + """, newest AS (SELECT DISTINCT trading_day FROM ev ORDER BY 1 DESC LIMIT 3)
SELECT symbol, max(seq) AS max_seq FROM ev WHERE trading_day IN (FROM newest) AND seq IS NOT NULL GROUP BY 1""",
)
def i15_persisted_seqs(spark, sf_dir):
    """The highest seqs that a stream's batches raise as they are stored, after one of them was replayed."""
    ingest.streaming_session(spark)
    ticks = derived.event_ticks(spark, sf_dir)
    stream = _landed(spark, ticks, "landing", "recv_ts_ms")
    store, check = TickStore(spark, shared_folder(spark, "store")), shared_folder(spark, "checkpoint")
    _finish(ingest.load_ticks(stream, store, check, wait=None))
    store.append_ticks(ticks.where("ingest_ordinal % 2 = 0"), load=ingest.load_name(check), epoch=1)
    store.append_ticks(ticks.limit(0))
    store.drop_old_versions()
    return store.persisted_seqs(recent=3)


# four steps of six hours each day; what a step may collide with among the steps before
LOOKED_AT_SQL = """, st AS (SELECT *, recv_ts_ms // 21600000 % 4 AS step FROM ev),
kept AS (SELECT DISTINCT ON (trading_day, symbol, coalesce(seq::VARCHAR, concat_ws('|', ts_ms, price, volume, turnover, CASE WHEN price IS NULL THEN ingest_ordinal END))) *
  FROM st ORDER BY step, recv_ts_ms, ingest_ordinal),
r AS (SELECT step, trading_day, symbol, min(seq) AS low, max(seq) AS high,
    min(ts_ms) FILTER (seq IS NULL) AS first, max(ts_ms) FILTER (seq IS NULL) AS last FROM st GROUP BY ALL)
SELECT r.step, count(k.symbol) AS looked_at
FROM r LEFT JOIN kept k ON k.step < r.step AND k.trading_day = r.trading_day AND k.symbol = r.symbol
  AND (k.seq BETWEEN low AND high OR (k.seq IS NULL AND k.ts_ms BETWEEN first AND last))
GROUP BY 1"""


@query("i2_rows_looked_at", q.w(q.RESENT) + LOOKED_AT_SQL)
def i2_rows_looked_at(spark, sf_dir):
    """Stored rows that the loads of a day's four quarters compare themselves with: not those of the day."""
    ticks = derived.event_ticks(spark, sf_dir, resent=True)
    store = TickStore(spark, shared_folder(spark, "store"))
    looked = []
    for step in range(4):
        batch = ticks.where(F.floor(F.col("recv_ts_ms") / 21_600_000) % 4 == step)
        looked.append((step, store.colliding(batch).count()))
        store.append_ticks(batch, load="quarters", epoch=step)
    return spark.createDataFrame(looked, "step long, looked_at long")


@query("i3_gaps_by_slices", CHECKS["i3_stream_gaps"])
def i3_gaps_by_slices(spark, sf_dir):
    """Live gaps with a symbol's micro-batch cut into slices equal the batch form."""
    ingest.streaming_session(spark)
    stream = _landed(spark, derived.event_ticks(spark, sf_dir), "landing", "ts_ms")
    store = TickStore(spark, shared_folder(spark, "store"))
    _finish(gap_slices.load_gaps_by_slices(stream, store, GAP_PARAMS, shared_folder(spark, "checkpoint"), wait=None))
    return store.gaps().drop("detected_at_ms", "meta_json")


@query("i5_late_by_slices", CHECKS["i5_late_ticks"])
def i5_late_by_slices(spark, sf_dir):
    """The same with every third tick first: late ticks change no gap found before."""
    ingest.streaming_session(spark)
    ticks = derived.event_ticks(spark, sf_dir)
    mixed = ticks.withColumn("step", F.floor(F.col("ingest_ordinal") / 2) % 3)
    store = TickStore(spark, shared_folder(spark, "store"))
    stream = _landed(spark, mixed, "landing", "step")
    _finish(gap_slices.load_gaps_by_slices(stream, store, GAP_PARAMS, shared_folder(spark, "checkpoint"), wait=None))
    return store.gaps().select("symbol", "gap_start_ts_ms", "gap_end_ts_ms")
