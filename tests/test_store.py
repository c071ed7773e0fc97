import os
import time

import pytest
from tick_rows import hk_ms, tick
from pyspark.sql import functions as F

from tickweave.operators import archive, dedupe, export, stats
from tickweave.params import QualityParams
from tickweave.plans import commands
from tickweave.plans.stream_queries import Lost, LostOnce
from tickweave.schema import GAPS
from tickweave.session import shared_folder
from tickweave.sources.store import TickStore

D, T0 = "20240102", hk_ms("20240102", "10:10:00")


@pytest.fixture
def store(spark):
    return TickStore(spark, shared_folder(spark, "store"))


def test_duplicate_seq(store, make_ticks):
    rows = [
        tick("HK.00700", D, T0, 1),
        tick("HK.00700", D, T0 + 1, 2),
        tick("HK.00700", D, T0 + 2, 2),
        tick("HK.00981", D, T0, 1),
    ]
    result = store.append_ticks(make_ticks(rows))
    assert (result.batch, result.inserted, result.ignored) == (4, 3, 1)
    top = {r.symbol: r.max_seq for r in store.fetch_max_seq_by_symbol(D, ["HK.00700", "HK.00981"]).collect()}
    assert top == {"HK.00700": 2, "HK.00981": 1}
    kept = store.ticks().where("symbol = 'HK.00700' AND seq = 2").first()
    assert kept.ts_ms == T0 + 1  # first arrival


def test_loading_twice_adds_nothing(store, make_ticks):
    rows = [tick("HK.1", D, T0 + i, i) for i in range(5)] + [tick("HK.1", D, T0, None)]
    assert store.append_ticks(make_ticks(rows)).inserted == 6
    again = store.append_ticks(make_ticks(rows))
    assert (again.batch, again.inserted) == (6, 0)
    assert store.ticks().count() == 6


def test_null_rules(store, make_ticks):
    rows = [
        tick("A", D, T0, None),
        tick("A", D, T0, None),  # same seq-less key: one kept
        tick("B", D, T0, None, price=None),
        tick("B", D, T0, None, price=None),  # unknown price: both kept
        tick("C", D, T0, None, price=float("nan")),
        tick("C", D, T0, None, price=float("nan")),  # NaN is stored as unknown
        tick("D", D, T0, 5, price=None),
        tick("D", D, T0, 5, price=None),  # same seq: one kept
        tick(None, D, T0, 1),  # lacks a required column: ignored
        tick("E", D, T0, None, price=0.0),
        tick("E", D, T0, None, price=-0.0),
    ]
    df = make_ticks(rows)
    counts = dedupe.dedupe_counts(df).first()
    assert (counts.batch, counts.inserted, counts.ignored) == (11, 7, 4)
    assert store.append_ticks(df).inserted == 7
    kept = {r.symbol: r["count"] for r in store.ticks().groupBy("symbol").count().collect()}
    assert kept == {"A": 1, "B": 2, "C": 2, "D": 1, "E": 1}
    assert store.ticks().where("symbol = 'C' AND price IS NULL").count() == 2


def test_same_seq_on_two_days(store, make_ticks):
    rows = [tick("A", "20240102", T0, 7), tick("A", "20240103", T0 + 86_400_000, 7)]
    assert store.append_ticks(make_ticks(rows)).inserted == 2
    assert sorted(r[0] for r in store.recent_trading_days(5).collect()) == ["20240102", "20240103"]
    assert store.ticks(["20240103"]).count() == 1


def test_hot_key_collapses(make_ticks, spark):
    one = make_ticks([tick("A", D, T0, 1), tick("B", D, T0, 2)])
    copies = one.crossJoin(spark.range(2000)).withColumn("ingest_ordinal", F.col("id")).drop("id")
    assert dedupe.dedupe_ticks(copies).count() == 2
    plan = dedupe.dedupe_ticks(copies)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one before the shuffle, one after


def test_recent_max_seq(store, make_ticks):
    rows = [
        tick("HK.00700", "20240102", T0, 120),
        tick("HK.00700", "20240103", T0 + 86_400_000, 150),
        tick("HK.00700", "20231201", T0 - 86_400_000, 999),
        tick("HK.00700", "odd-day", T0, 5000),
    ]
    store.append_ticks(make_ticks(rows))
    get = store.fetch_max_seq_by_symbol_recent
    assert get(["HK.00700"], ["20240104", "20240103", "20240102"]).first().max_seq == 150
    assert get(["HK.00700"], recent=2).first().max_seq == 150
    assert get(["HK.00700"], recent=3).first().max_seq == 999
    assert stats.usable_days([" 20240104", "x", "20240104", "2024-01-05"]) == ["20240104"]
    assert tuple(store.fetch_tick_stats("20240102").first()) == (1, T0)


@pytest.mark.parametrize(
    "base, seqs, kept, dup", [(10, [9, 11, 20], [11, 20], 1), (10, [10, 11], [11], 1)]
)
def test_poll_baseline(spark, make_ticks, base, seqs, kept, dup):
    polled = make_ticks([tick("S", D, T0 + s, s, push_type="poll") for s in seqs])
    baseline = spark.createDataFrame([("S", base)], "symbol string, max_seq bigint")
    flagged = dedupe.flag_polled(polled, baseline)
    assert sorted(r.seq for r in flagged.where("outcome = 'kept'").collect()) == kept
    assert dedupe.poll_counts(flagged).first().dropped_duplicate == dup


def test_poll_repeats_and_other_symbols(spark, make_ticks):
    rows = [
        tick("S", D, T0, None),
        tick("S", D, T0, None),
        tick("S", D, T0 + 1, None, price=None),
        tick("S", D, T0 + 1, None, price=None),  # equal keys, the unknown part included
        tick("S", D, T0 + 2, None),
        tick("X", D, T0, 3),
        tick("S", D, T0, 4),
        tick("S", D, T0, 4),
    ]
    polled = make_ticks(rows)
    known = make_ticks([tick("S", D, T0 + 2, None)])
    baseline = spark.createDataFrame([], "symbol string, max_seq bigint")
    flagged = dedupe.flag_polled(polled, baseline, known, wanted_symbol="S")
    got = sorted((r.ingest_ordinal, r.outcome) for r in flagged.collect())
    assert [o for _, o in got] == [
        "kept", "duplicate", "kept", "duplicate", "duplicate", "filtered", "kept", "duplicate",
    ]


def test_gap_sink_keeps_the_first(store, spark):
    gap = ("20260216", "A", 1, 5, 0.004, 100, "hard_gap", "{}")
    later = gap[:5] + (200,) + gap[6:]
    store.append_gaps(spark.createDataFrame([gap, later], GAPS))
    store.append_gaps(spark.createDataFrame([later], GAPS))
    assert [r.detected_at_ms for r in store.gaps().collect()] == [100]


def test_missing_tables(store):
    assert store.ticks().count() == 0 and not store.has_ticks()
    got = commands.validate(store, ["20240102"], T0).first()
    assert (got.status, got.reasons) == ("FAIL", ["db_not_found"])


def _archive(store, make_ticks, days):
    rows = [tick("A", d, hk_ms(d, "10:00:00") + i, i) for d in days for i in range(3)]
    store.append_ticks(make_ticks(rows))
    root = shared_folder(store.spark, "archive")
    return root, *commands.archive(store, root, QualityParams(), T0, keep_days=1)


def test_archive_and_retention(store, make_ticks, spark):
    root, manifest, expired = _archive(store, make_ticks, ["20260215", "20260216"])
    rows = manifest.orderBy("trading_day").collect()
    assert [(r.trading_day, r.ticks_count, r.verify_ok, r.compression) for r in rows] == [
        ("20260215", 3, True, "zstd"),
        ("20260216", 3, True, "zstd"),
    ]
    assert [r[0] for r in expired.collect()] == ["20260215"]
    assert archive.verify_checksums(spark, root).where("NOT checksum_ok").count() == 0
    none = archive.expired_days(store.ticks(), manifest.where("trading_day > '20260215'"), 0)
    assert [r[0] for r in none.collect()] == ["20260216"]  # the other day is not verified
    assert archive.delete_expired(store, manifest, 1, root) == ["20260215"]
    assert [r[0] for r in store.recent_trading_days(5).collect()] == ["20260216"]
    assert archive.archived_ticks(spark, root).count() == 6


def test_changed_archive_fails(store, make_ticks, spark):
    root, _, _ = _archive(store, make_ticks, ["20260216"])
    archived = archive.archived_ticks(spark, root)
    changed = archived.withColumn("price", F.col("price") + 1)
    assert not archive.verify(store.ticks(), changed).first().verify_ok
    assert not archive.verify(store.ticks(), archived.where("seq > 0")).first().verify_ok
    extra = spark.createDataFrame([("trading_day=20260216/x.parquet", 1, "00")], "file string, bytes bigint, sha256 string")
    extra.write.mode("append").parquet(f"{root}/checksums/trading_day=20260216")
    assert archive.verify_checksums(spark, root).where("NOT checksum_ok").count() == 1


def test_a_day_with_rows_since_its_archive_is_kept(store, make_ticks):
    root, manifest, _ = _archive(store, make_ticks, ["20260214", "20260215", "20260216"])
    store.append_ticks(make_ticks([tick("A", "20260214", hk_ms("20260214", "11:00:00"), 99)]))
    chosen = lambda: [r[0] for r in archive.expired_days(store.ticks(), manifest, 1, root).collect()]
    assert chosen() == ["20260215"]
    assert archive.delete_expired(store, manifest, 1, root) == ["20260215"]
    assert store.ticks(["20260214"]).count() == 4


def test_a_changed_file_still_fails_after_another_day_is_archived(store, make_ticks, spark):
    root, _, _ = _archive(store, make_ticks, ["20260215"])
    file = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/ticks").first()
    path = file["path"].removeprefix("file:")
    content = bytearray(file["content"])
    content[len(content) // 2] ^= 1
    with open(path, "wb") as out:
        out.write(content)
    folder, name = os.path.split(path)
    os.unlink(f"{folder}/.{name}.crc")  # the local file system's own guard, which other stores lack
    store.append_ticks(make_ticks([tick("A", "20260216", hk_ms("20260216", "10:00:00"), 1)]))
    manifest = archive.archive_days(store, root, QualityParams(), T0, ["20260216"])
    bad = archive.verify_checksums(spark, root).where("NOT checksum_ok")
    assert [r.trading_day for r in bad.collect()] == ["20260215"]
    assert archive.verify_checksums(spark, root, ["20260216"]).where("NOT checksum_ok").count() == 0
    assert archive.expired_days(store.ticks(), manifest, 0, root).collect()[0][0] == "20260216"
    row = manifest.where("trading_day = '20260216'").first()
    assert row.archive_bytes > 0 and len(row.archive_sha256) == 64 and row.source_path.endswith("=20260216")


def test_a_repeated_batch_adds_nothing(store, make_ticks):
    rows = [tick("A", D, T0, 1), tick("A", D, T0, None, price=None), tick("A", D, T0, None)]
    assert store.append_ticks(make_ticks(rows), load="x", epoch=4).inserted == 3
    again = store.append_ticks(make_ticks(rows), load="x", epoch=4)
    assert (again.batch, again.inserted) == (3, 0)
    with pytest.raises(Lost):  # another load brings a second row without identity, and is lost behind its write
        LostOnce(store.spark, store.root).append_ticks(make_ticks(rows), load="y", epoch=0)
    assert store.unfinished() and store.ticks().count() == 4
    assert store.append_ticks(make_ticks(rows), load="y", epoch=0).inserted == 0
    assert not store.unfinished()
    assert store.append_ticks(make_ticks(rows), load="y", epoch=1).inserted == 1
    assert store.ticks().count() == 5


def test_a_batch_lost_before_its_write_is_written_whole(store, make_ticks):
    """A true second row of an earlier batch is no copy."""
    rows = make_ticks([tick("A", D, T0, None, price=None)])
    store.append_ticks(rows, load="x", epoch=0)
    store._begin("x", 1)
    time.sleep(1.1)
    assert store.append_ticks(rows, load="x", epoch=1).inserted == 1
    assert store.append_ticks(rows, load="x", epoch=1).inserted == 0


def test_highest_seqs_are_raised_by_every_batch(store, make_ticks, spark):
    days = ["20260216", "20260217"]
    batches = [
        [tick("A", days[0], T0, 5), tick("B", days[0], T0, None), tick("A", days[0], T0, 3)],
        [tick("A", days[0], T0, 4), tick("A", days[1], T0, 1)],
        [tick("A", days[0], T0, 9), tick("C", days[1], T0, 2)],
    ]
    for batch in batches:
        store.append_ticks(make_ticks(batch))
    want = {(days[0], "A"): 9, (days[0], "B"): None, (days[1], "A"): 1, (days[1], "C"): 2}

    def found(frame):
        return {(r["trading_day"], r["symbol"]): r["max_seq"] for r in frame.collect()}

    assert found(store.highest_seqs()) == want
    assert found(store.highest_seqs([days[1]])) == {k: v for k, v in want.items() if k[0] == days[1]}
    # a version written in part and never published changes nothing
    torn = spark.createDataFrame([(days[0], 3, "A", 99)], "trading_day string, version long, symbol string, max_seq long")
    torn.write.mode("append").partitionBy("trading_day", "version").parquet(store.baseline_path)
    assert found(store.highest_seqs()) == want
    store.drop_old_versions()
    assert found(store.highest_seqs()) == want
    assert {r["symbol"]: r["max_seq"] for r in store.persisted_seqs(1).collect()} == {"A": 1, "C": 2}
    assert found(TickStore(spark, shared_folder(spark, "none")).highest_seqs()) == {}


def test_highest_seqs_after_a_lost_batch_without_a_name(store, make_ticks):
    lost = LostOnce(store.spark, store.root)
    with pytest.raises(Lost):
        lost.append_ticks(make_ticks([tick("A", D, T0, 7)]))
    assert store.unfinished() and store.persisted_seqs().first()["max_seq"] == 7
    store.append_ticks(make_ticks([tick("A", D, T0 + 1, 2), tick("B", D, T0, 1)]))
    assert not store.unfinished()
    assert {r["symbol"]: r["max_seq"] for r in store.highest_seqs().collect()} == {"A": 7, "B": 1}


def test_marks_of_old_batches_go_and_the_newest_stay(store, make_ticks):
    for epoch in range(12):
        store.append_ticks(make_ticks([tick("A", D, T0, epoch)]), load="x", epoch=epoch)
    marks = store._marks("x")
    assert max(marks["done"]) == 11 and len(marks["done"]) <= 8
    assert store.append_ticks(make_ticks([tick("A", D, T0, 3)]), load="x", epoch=3).inserted == 0


def test_a_small_batch_reads_no_whole_day(store, make_ticks, spark):
    """Rows that scans bring, by Spark's own count, for a batch against a day of many files."""
    for part in range(6):
        rows = [tick(s, D, T0 + part * 1000 + i, part * 500 + i) for s in "AB" for i in range(500)]
        store.append_ticks(make_ticks(rows), load="x", epoch=part)
    batch = make_ticks([tick("A", D, T0 + 6000, 3000), tick("B", D, T0 + 2100, 1100)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        looked = store.colliding(batch)
        assert [(r["symbol"], r["seq"]) for r in looked.collect()] == [("B", 1100)]
        leaves = looked._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size()) if "Scan parquet" in leaves.apply(i).nodeName()]
        read = sum(scan.metrics().get("numOutputRows").get().value() for scan in scans)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 1 <= read <= 1000  # one file of six: the others' ranges lie beyond the batch


def test_batches_of_many_days_and_symbols_are_bounded_as_one(store, make_ticks, monkeypatch):
    from tickweave.sources import store as module

    monkeypatch.setattr(module, "MOST_RANGES", 2)
    rows = [tick(f"S{i % 7}", D, T0 + i, i if i % 3 else None) for i in range(60)]
    assert store.append_ticks(make_ticks(rows)).inserted == 60
    assert store.append_ticks(make_ticks(rows)).inserted == 0
    assert store.append_ticks(make_ticks([tick("S1", D, T0, 500)])).inserted == 1


def test_vendor_export_order(store, make_ticks, spark):
    rows = [
        tick("HK.1", D, T0 + 5, 2),
        tick("HK.1", D, T0 + 5, None),
        tick("HK.1", D, T0, 9),
        tick("a/b", D, T0, 1),
    ]
    ticks = make_ticks(rows)
    path = shared_folder(spark, "csv")
    export.export_vendor_csv(ticks, path)
    import glob

    lines = []
    for part in sorted(glob.glob(f"{path}/trading_day={D}/file=HK.1/*.csv")):
        with open(part, encoding="utf-8") as fh:
            lines += fh.read().splitlines()[1:]
    assert [ln.split(",")[7] for ln in lines] == ["9", "", "2"]
    assert glob.glob(f"{path}/trading_day={D}/file=a_b/*.csv")
    placed = stats.export_positions(ticks, slice_ms=2).orderBy("symbol", "position").collect()
    assert [(r.symbol, r.seq, r.position) for r in placed] == [
        ("HK.1", 9, 1), ("HK.1", None, 2), ("HK.1", 2, 3), ("a/b", 1, 1),
    ]


def test_footprint_and_pending(store, make_ticks, spark):
    store.append_ticks(make_ticks([tick("A", D, T0, 1)]))
    got = commands.db_stats(store).first()
    assert got.rows == 1 and got.files >= 1 and got.bytes > 0
    asked = spark.createDataFrame([("20240101",), ("20240102",)], "trading_day string")
    done = asked.where("trading_day = '20240101'")
    assert [r[0] for r in archive.pending_days(asked, done).collect()] == ["20240102"]
    assert archive.pending_days(asked, done, force=True).count() == 2


def test_daily_quality_last_writer_wins(store, spark):
    schema = store.daily_quality().schema
    row = lambda d, at, host: (d, at, host, "[]", "{}")
    store.upsert_daily_quality(spark.createDataFrame([row("1", 1, "a"), row("2", 1, "a")], schema))
    store.upsert_daily_quality(spark.createDataFrame([row("2", 3, "c"), row("2", 2, "b")], schema))
    got = {r.trading_day: r.host for r in store.daily_quality().collect()}
    assert got == {"1": "a", "2": "c"}


def test_files_are_sorted(store, make_ticks):
    rows = [tick(s, D, T0 + (i * 7919) % 1000, i) for s in ("B", "A") for i in range(300)]
    store.append_ticks(make_ticks(rows))
    import glob

    import pyarrow.parquet as pq

    for path in glob.glob(f"{store.ticks_path}/trading_day={D}/*.parquet"):
        table = pq.read_table(path, columns=["symbol", "ts_ms"]).to_pydict()
        pairs = list(zip(table["symbol"], table["ts_ms"]))
        assert pairs == sorted(pairs)


def test_retention_opens_no_file_of_days_that_stay(store, make_ticks, spark):
    """Files of the newest days are spoilt: whoever opened one would fail."""
    import glob

    days = ["20260213", "20260216", "20260217", "20260218"]
    for day in days:
        store.append_ticks(make_ticks([tick("A", day, hk_ms(day, "10:00:00") + i, i) for i in range(4)]))
    root = shared_folder(spark, "archive")
    archive.archive_days(store, root, QualityParams(), T0)
    store.append_ticks(make_ticks([tick("A", days[1], hk_ms(days[1], "11:00:00"), 77)]))
    for day in days[2:]:
        for path in glob.glob(f"{store.ticks_path}/trading_day={day}/*.parquet"):
            with open(path, "wb") as file:
                file.write(b"spoilt")
    assert [r[0] for r in archive.expired_stored_days(store, root, 2).collect()] == [days[0]]


def test_day_prints_read_each_file_once(store, make_ticks, spark):
    import glob

    rows = [tick("A", D, T0 + i, i) for i in range(5)]
    store.append_ticks(make_ticks(rows[:3]))
    first = store.day_prints([D]).first()
    assert (first["ticks_count"], first["max_ts_ms"]) == (3, T0 + 2)
    for path in glob.glob(f"{store.ticks_path}/trading_day={D}/*.parquet"):
        with open(path, "wb") as file:
            file.write(b"spoilt")  # its figures are known
    other = TickStore(spark, shared_folder(spark, "store"))
    other.append_ticks(make_ticks(rows[3:]))
    assert store.day_prints([D]).first() == first
    assert other.day_prints([D]).first()["ticks_count"] == 2
    assert store.day_prints(["20250101"]).count() == 0 and store.day_prints([]).count() == 0
