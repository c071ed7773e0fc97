"""State of streams that run for ever: bounded memories, closing days, slices, sources by rows."""

import json
import random

import pytest
from pyspark.sql import functions as F
from tick_rows import hk_ms, tick

from tickweave.operators import gaps
from tickweave.operators.folds import AdmissionFold, RecentKeysFold, RepeatFold
from tickweave.params import QualityParams
from tickweave.session import shared_folder
from tickweave.sources import rows_source
from tickweave.sources.store import TickStore
from tickweave.streaming import closing, gap_slices, ingest

D = "20260216"
T0 = hk_ms(D, "10:00:00")


def steps(fold, rows):
    state, out = fold.start(), []
    for at, *row in rows:
        state = json.loads(json.dumps(state))  # as it comes back from the state store
        out.append(fold.step(state, at, tuple(row))[0])
    return out, state


def test_repeats_are_compared_with_every_kept_time():
    fold = RepeatFold(600_000)
    kept, state = steps(fold, [(0,), (2_000_000,), (0,), (600_000,), (600_001,), (1_999_000,)])
    assert kept == [True, True, False, False, True, False]
    assert fold.until(state) == 2_600_001


@pytest.mark.parametrize("limit", [1, 3, 500])
def test_newest_keys_first_in_first_out(limit):
    source = random.Random(limit)
    rows = [(i, source.choice(["push", "poll"]), source.randrange(limit * 2), 1.0, None, 2.5) for i in range(4_000)]
    got, state = steps(RecentKeysFold(limit), rows)
    queue, want = [], []
    for _, origin, key, *_ in rows:
        want.append(origin != "poll" or key not in queue)
        if key not in queue:
            queue.append(key)
            del queue[:-limit]
    assert got == want and len(state["keys"]) <= limit


def test_admission_state_ends_with_its_window():
    fold = AdmissionFold(2, 60)
    _, state = steps(fold, [(0,), (10_000,), (20_000,)])
    assert fold.until(state) == 70_000
    assert fold.until(fold.start()) is None


def test_ends_of_local_days(spark):
    times = [hk_ms(D, "00:00:00"), hk_ms(D, "23:59:59"), T0]
    want = [hk_ms("20260217", "00:00:00")] * 3
    assert closing.day_end(times, "Asia/Hong_Kong").tolist() == want
    frame = spark.createDataFrame([(t,) for t in times], "t long")
    got = frame.select(closing.day_end_of(F.col("t"), "Asia/Hong_Kong").alias("e")).collect()
    assert [r["e"] for r in got] == want


def streamed_gaps(spark, make_ticks, batches, params):
    landing, check = shared_folder(spark, "landing"), shared_folder(spark, "checkpoint")
    store = TickStore(spark, shared_folder(spark, "store"))
    for i, rows in enumerate(batches):
        make_ticks(rows).coalesce(1).write.parquet(f"{landing}/{i}")
        stream = spark.readStream.schema(make_ticks(rows).schema).option("recursiveFileLookup", "true")
        running = gap_slices.load_gaps_by_slices(stream.parquet(landing), store, params, check, wait=None)
        running.awaitTermination()
    return store, check


@pytest.mark.parametrize("least", [1, 4])
def test_one_symbol_over_many_slices_equals_the_batch_form(spark, make_ticks, least):
    params = QualityParams(gap_threshold_sec=5, active_window_sec=30, active_min_ticks=least, slice_ms=10_000)
    source, at, rows = random.Random(least), T0, []
    for i in range(900):
        at += source.choice([200, 400, 700, 900, 1500, 7000 if i % 9 == 0 else 300])
        rows.append(tick("HOT", D, at, i))
    batches = [rows[:250], rows[250:251], rows[240:600], rows[600:]]
    store, _ = streamed_gaps(spark, make_ticks, batches, params)
    key = lambda r: (r["symbol"], r["gap_start_ts_ms"], r["gap_end_ts_ms"], json.loads(r["meta_json"])["active_count"])
    want = sorted(key(r) for r in gaps.hard_gaps(make_ticks(rows), params, 0).collect())
    assert len(want) > 10 and sorted(key(r) for r in store.gaps().collect()) == want
    slices = gaps.tick_points(make_ticks(rows).repartition(4), params)
    assert slices.select((F.col("ts_ms") / 30_000).cast("long")).distinct().count() > 4


def test_a_batch_of_slices_may_be_repeated(spark, make_ticks):
    params = QualityParams(gap_threshold_sec=5, active_window_sec=60, active_min_ticks=1)
    first, second = [tick("A", D, T0 + i * 1000, i) for i in range(5)], [tick("A", D, T0 + 20_000, 9), tick("A", D, T0 - 5, 8)]
    store, check = streamed_gaps(spark, make_ticks, [first, second], params)
    folder = f"{store.root}/gap_points/{ingest.load_name(check)}"
    found, left = gap_slices.batch_gaps(make_ticks(second), gap_slices._tail(store, folder, 1), params)
    before = store.gaps().count()
    store.append_gaps(found)
    assert before == store.gaps().count() == 1
    assert store.gaps().first()["detected_at_ms"] == T0 + 20_003
    assert {r["ts_ms"] for r in left.collect()} == {T0 + i * 1000 for i in (0, 1, 2, 3, 4, 20)}


def test_rows_are_admitted_by_number_over_files_and_restarts(spark, tmp_path):
    landing, check, out = (str(tmp_path / name) for name in ("landing", "check", "out"))

    def run(most):
        rows = rows_source.stream_rows(spark, landing, schema, f"{check}/ledger", most)
        writer = rows.writeStream.foreachBatch(
            lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        )
        running = writer.option("checkpointLocation", f"{check}/query").start()
        try:
            running.processAllAvailable()
        finally:
            running.stop()
        return {r["epoch"]: r["n"] for r in spark.read.parquet(out).groupBy("epoch").agg(F.count(F.lit(1)).alias("n")).collect()}

    rows = spark.range(0, 25).select(F.col("id").alias("n"), F.lit("x").alias("word"))
    schema = rows.schema
    rows.coalesce(1).write.option("parquet.block.size", 64).parquet(f"{landing}/a")
    spark.range(25, 32).select(F.col("id").alias("n"), F.lit(None).cast("string").alias("word")).coalesce(1).write.parquet(f"{landing}/b")
    assert run(10) == {0: 10, 1: 10, 2: 10, 3: 2}
    # a file of an earlier name comes later, and counts behind those seen already
    spark.range(32, 45).select(F.col("id").alias("n"), F.lit("y").alias("word")).coalesce(1).write.parquet(f"{landing}/0")
    assert run(6) == {0: 10, 1: 10, 2: 10, 3: 2, 4: 6, 5: 6, 6: 1}
    assert sorted(r["n"] for r in spark.read.parquet(out).collect()) == list(range(45))
    with pytest.raises(ValueError):
        rows_source.RowsReader(schema, {"path": landing, "ledger": f"{check}/other", "maxRows": "0"})


def repeats_in_steps(spark, make_ticks, steps, **settings):
    """The ids that ``drop_recent_repeats`` keeps of each step, and how many states are held at the end."""
    landing, check, out = (shared_folder(spark, name) for name in ("landing", "checkpoint", "kept"))
    ingest.streaming_session(spark)
    for i, rows in enumerate(steps):
        frame = make_ticks(rows).coalesce(1)
        frame.write.parquet(f"{landing}/{i}")
        stream = spark.readStream.schema(frame.schema).option("recursiveFileLookup", "true").parquet(landing)
        kept = ingest.drop_recent_repeats(stream, **settings)
        writer = kept.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True)
        writer.start(out).awaitTermination()
    state = spark.read.format("statestore").option("path", check).option("stateVarName", "fold").load()
    return sorted(r["ingest_ordinal"] for r in spark.read.parquet(out).collect()), state.count()


def test_repeats_of_ten_minutes_share_a_state(spark, make_ticks):
    """Keys that differ in any part, a missing one included, are told apart within it, and each ends by itself."""
    start = T0 // 600_000 * 600_000

    def row(i, at, recv, **more):
        return tick("A", D, start + at, None, recv_ts_ms=start + recv, **more) | {"ingest_ordinal": i}

    first = [row(i, i * 1000, i * 1000) for i in range(100)]
    first += [row(100, 0, 0, price=None), row(101, 0, 1, price=None), row(102, 0, 0, volume=7), row(103, 0, 600_000)]
    again = [row(200 + i, i * 1000, 600_000 + i * 2000) for i in range(5)]
    kept, states = repeats_in_steps(spark, make_ticks, [first, again])
    # the first key comes again at its horizon, the others behind theirs
    assert kept == [*range(100), 100, 102, 201, 202, 203, 204] and states == 1


def test_a_shared_state_ends_key_by_key(spark, make_ticks):
    start = T0 // 600_000 * 600_000

    def row(i, at, recv):
        return tick("A", D, start + at, None, recv_ts_ms=start + recv) | {"ingest_ordinal": i}

    first, open_still = row(0, 0, 0), row(1, 1000, 500_000)
    later = tick("B", D, start + 9_000_000, None, recv_ts_ms=start + 700_000) | {"ingest_ordinal": 2}
    end = tick("B", D, start + 9_900_000, None, recv_ts_ms=start + 5_000_000) | {"ingest_ordinal": 6}
    # behind the watermark the first key is forgotten, the second is not
    steps = [[first, open_still], [later], [row(3, 5000, 700_000)], [row(4, 0, 100), row(5, 1000, 400_000)], [end], [end]]
    kept, states = repeats_in_steps(spark, make_ticks, steps, late_ms=0)
    assert kept == [0, 1, 2, 3, 4, 6] and states == 1
