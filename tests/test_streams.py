import dataclasses

import pytest
from tick_rows import hk_ms, tick
from pyspark.sql import functions as F

from tickweave.operators import folds, gaps
from tickweave.params import HealthParams, QualityParams
from tickweave.session import shared_folder
from tickweave.sources import feed
from tickweave.sources.store import TickStore
from tickweave.streaming import decision_stream, gap_stream, ingest

DAY = "20260216"
P = dataclasses.replace(QualityParams(), active_min_ticks=2)


@pytest.fixture
def landing(spark):
    """A folder that receives one file set per call, and a stream over it."""
    ingest.streaming_session(spark)
    path = shared_folder(spark, "landing")

    class Landing:
        steps = 0

        def add(self, df):
            df.coalesce(1).write.parquet(f"{path}/step={self.steps:03d}")
            self.steps += 1
            self.schema = df.schema

        def stream(self):
            reader = spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
            return reader.option("maxFilesPerTrigger", 1).parquet(path)

    return Landing()


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_load_restart_and_poll_baseline(spark, make_ticks, landing):
    store = TickStore(spark, shared_folder(spark, "store"))
    check = shared_folder(spark, "check")
    heard = []

    def load():
        run(
            ingest.load_ticks(
                landing.stream(), store, check, wait=None, poll_baseline_days=2,
                observer=lambda epoch, r: heard.append((epoch, r.batch, r.inserted)),
            )
        )

    t = hk_ms(DAY, "10:00:00")
    landing.add(make_ticks([tick("A", DAY, t + i, i) for i in (1, 2, 5)]))
    load()
    landing.add(
        make_ticks(
            [
                tick("A", DAY, t + 4, 4, push_type="poll"),  # below the stored 5: lost by poll
                tick("A", DAY, t + 6, 6, push_type="poll"),
                tick("A", DAY, t + 3, 3),  # a push is not filtered
                tick("A", DAY, t + 5, 5),  # stored already
            ]
        )
    )
    load()
    load()  # nothing new
    assert sorted(r.seq for r in store.ticks().collect()) == [1, 2, 3, 5, 6]
    assert [h[0] for h in heard] == [0, 1] and heard[0][1:] == (3, 3) and heard[1][2] == 2


def collect_stream(spark, stream, landing):
    out, check = shared_folder(spark, "out"), shared_folder(spark, "check")

    def once():
        run(
            stream().writeStream.format("parquet")
            .option("checkpointLocation", check)
            .trigger(availableNow=True)
            .start(out)
        )

    return once, lambda: spark.read.parquet(out)


def test_gap_state_over_batches(spark, make_ticks, landing):
    a, b, c, d = (hk_ms(DAY, x) for x in ("10:00:00", "10:00:01", "10:00:30", "10:00:45"))
    landing.add(make_ticks([tick("A", DAY, b, 2), tick("A", DAY, a, 1)]))
    landing.add(make_ticks([tick("A", DAY, c, 3)]))
    once, read = collect_stream(
        spark, lambda: gap_stream.stream_gaps(landing.stream(), P), landing
    )
    once()
    found = {(r.gap_start_ts_ms, r.gap_end_ts_ms) for r in read().collect()}
    assert found == {(b, c)}
    # a late tick inside the gap neither withdraws it nor moves the state
    landing.add(make_ticks([tick("A", DAY, hk_ms(DAY, "10:00:15"), 9)]))
    landing.add(make_ticks([tick("A", DAY, d, 4)]))
    once()
    found = {(r.gap_start_ts_ms, r.gap_end_ts_ms) for r in read().collect()}
    assert found == {(b, c), (c, d)}
    # the batch form over everything is the corrected truth
    every = make_ticks(
        [tick("A", DAY, t, i) for i, t in enumerate((a, b, hk_ms(DAY, "10:00:15"), c, d))]
    )
    batch = {(r.gap_start_ts_ms, r.gap_end_ts_ms) for r in gaps.hard_gaps(every, P, 1).collect()}
    assert (b, c) not in batch and (c, d) in batch


def test_alert_stream_equals_batch(spark, landing):
    import random

    rnd = random.Random(9)
    schema = (
        "created_at_ms bigint, ord bigint, kind string, code string, key string, "
        "fingerprint string, trading_day string, severity string, sid string, eid string"
    )
    rows, at = [], 0
    for i in range(200):
        at += rnd.choice([1000, 60_000, 300_000])
        kind = "resolve" if rnd.random() < 0.1 else "alert"
        rows.append((at, i, kind, "C", "", rnd.choice("ab"), "d", rnd.choice(["WARN", "ALERT"]), None, f"e{i}"))
    df = spark.createDataFrame(rows, schema)
    for lo in (0, 70, 140):
        landing.add(df.where((F.col("ord") >= lo) & (F.col("ord") < lo + 70)))
    p = HealthParams()
    once, read = collect_stream(
        spark, lambda: decision_stream.stream_alerts(landing.stream(), p), landing
    )
    once()
    batch = folds.alert_decisions(df, p)
    shape = lambda d: sorted((r.ord, r.reason, r.emitted, r.incident_eid) for r in d.collect())
    assert shape(read()) == shape(batch)


def test_admission_stream(spark, landing):
    rows = [("k", i, i * 20_000) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, i bigint, t bigint")
    landing.add(df.where("i < 5"))
    landing.add(df.where("i >= 5"))
    once, read = collect_stream(
        spark,
        lambda: decision_stream.stream_admissions(landing.stream(), ["k"], "t", 2, 60.0),
        landing,
    )
    once()
    got = sorted((r.i, r.admitted) for r in read().collect())
    assert got == [(i, i % 3 != 2) for i in range(12)]


def test_recent_repeats(spark, make_ticks, landing):
    t = hk_ms(DAY, "10:00:00")
    late = t + 30 * 60_000
    landing.add(
        make_ticks(
            [
                tick("A", DAY, t, None), tick("A", DAY, t, None),
                tick("A", DAY, t, None, price=None), tick("A", DAY, t, None, price=None),
                tick("A", DAY, t, 1), tick("A", DAY, t, 1),
            ]
        )
    )
    landing.add(make_ticks([tick("A", DAY, t, None), tick("B", DAY, t, None, recv_ts_ms=late)]))
    once, read = collect_stream(
        spark, lambda: ingest.drop_recent_repeats(landing.stream()), landing
    )
    once()
    assert read().where("symbol = 'A' AND seq IS NULL AND price IS NOT NULL").count() == 1
    assert read().where("price IS NULL").count() == 1 and read().where("seq = 1").count() == 2
    assert read().where("symbol = 'B'").count() == 1


def test_recent_repeats_out_of_order(spark, make_ticks, landing):
    """Steps in falling receive order lose no row."""
    t = hk_ms(DAY, "10:00:00")
    rows = [tick("A", DAY, t + i * 60_000, None, recv_ts_ms=t + i * 60_000) for i in range(120)]
    for part in (rows[80:], rows[40:80], rows[:40], rows[35:45]):
        landing.add(make_ticks(part))
    once, read = collect_stream(
        spark, lambda: ingest.drop_recent_repeats(landing.stream()), landing
    )
    once()
    assert read().count() == 120


def test_log_lines_of_files_are_ordered_by_time(spark, tmp_path):
    from tickweave.plans import commands
    from tickweave.sources import logs

    folder = tmp_path / "logs"
    folder.mkdir()
    old = "".join(f"2024-01-01 00:{i // 60:02d}:{i % 60:02d} x health sid={i}\n" for i in range(600))
    (folder / "b-long-and-old.log").write_text(old)
    (folder / "a-new.log").write_text(
        "2024-01-02T00:00:01,250 y health sid=new\n2024-01-02 00:00:02 telegram_enqueue kind=HEALTH sid=1\n"
        "2024-01-02 00:00:03 telegram_enqueue kind=ALERT severity=WARN\n  continued\n"
    )
    last = commands.last_log_lines(spark, str(folder)).first()
    assert last.last_health.endswith("sid=new") and last.last_health_sent.endswith("sid=1")
    assert last.last_warning_sent.endswith("severity=WARN") and last.last_schema is None
    early = commands.last_log_lines(spark, str(folder), until="2024-01-01 00:05:00").first()
    assert early.last_health.endswith("sid=299") and early.last_health_sent is None
    assert logs.between(logs.read_logs(spark, str(folder)), "2024-01-02").count() == 3


def test_lines_without_a_time_stay_behind_their_message(spark, tmp_path):
    from tickweave.sources import logs

    (tmp_path / "a.log").write_text("no time yet\n2024-01-02 00:00:01 ERROR failed\nTraceback\n  at once\n2024-01-02 00:00:05 x\n")
    (tmp_path / "b.log").write_text("2024-01-02 00:00:03 health sid=1\nmore of it\n2024-01-02 00:00:04 y\n")
    lines = [r["line"] for r in logs.read_logs(spark, str(tmp_path)).orderBy("ord").collect()]
    assert lines == [
        "no time yet", "2024-01-02 00:00:01 ERROR failed", "Traceback", "  at once",
        "2024-01-02 00:00:03 health sid=1", "more of it", "2024-01-02 00:00:04 y", "2024-01-02 00:00:05 x",
    ]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")  # blocks shorter than some lines
    try:
        assert [r["line"] for r in logs.read_logs(spark, str(tmp_path)).orderBy("ord").collect()] == lines
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_feed_stream_from_json(spark, tmp_path):
    ingest.streaming_session(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"code":"HK.1","time":"2026-02-16 10:00:00","price":1.5,"sequence":3}\n'
        '{"code":"HK.1","time":"bad time","price":1.5,"sequence":4}\n'
    )
    raw = feed.stream_feed(spark, str(tmp_path / "in"))
    now = hk_ms(DAY, "10:00:01")
    ticks = feed.accepted(feed.normalize(raw, recv_ts_ms=F.lit(now), push_type="push"))
    store = TickStore(spark, shared_folder(spark, "store"))
    run(
        ingest.load_ticks(
            ticks, store, shared_folder(spark, "check"), wait=None
        )
    )
    got = store.ticks().collect()
    assert [(r.symbol, r.seq, r.trading_day) for r in got] == [("HK.1", 3, DAY)]


def test_health_stream_equals_batch(spark, landing):
    import random

    rnd = random.Random(6)
    schema = (
        "instance string, sid string, created_at_ms bigint, trading_day string, "
        "market_mode string, severity string, muted boolean"
    )
    modes = ["pre-open", "open", "open", "lunch-break", "after-hours", "holiday-closed"]
    rows = [
        (
            rnd.choice("ab"), f"s{i}", i * 400_000, f"d{i // 60}", rnd.choice(modes),
            rnd.choice(["OK", "OK", "WARN", "ALERT"]), rnd.random() < 0.2,
        )
        for i in range(240)
    ]
    df = spark.createDataFrame(rows, schema)
    landing.add(df.where("created_at_ms < 40000000"))
    landing.add(df.where("created_at_ms >= 40000000"))
    p = HealthParams()
    once, read = collect_stream(
        spark, lambda: decision_stream.stream_health_emissions(landing.stream(), p), landing
    )
    progress = ingest.LoadProgress()
    spark.streams.addListener(progress)
    once()
    spark.streams.removeListener(progress)
    shape = lambda d: sorted((r.sid, r.reason, r.emitted) for r in d.collect())
    got = shape(read())
    assert got == shape(folds.health_emissions(df, p))
    assert {"muted", "bootstrap", "holiday_daily_once"} <= {r[1] for r in got}


def test_log_stream_and_files(spark, tmp_path):
    from tickweave.plans import commands
    from tickweave.sources import logs

    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.log").write_text(
        "x health sid=1\n\nplain\nERROR token=abc\npoll_stats n=1\nz severity=WARN\n"
    )
    path = str(tmp_path / "logs")
    assert commands.logs(spark, path).count() == 2
    assert commands.logs(spark, path, ops=True).count() == 3
    lines = logs.read_logs(spark, path)
    last = logs.last_lines(lines).first()
    assert (last.last_health, last.last_alert) == ("x health sid=1", "z severity=WARN")
    assert [r.line for r in logs.shown_log(lines).orderBy("ord").collect()] == [
        "ERROR token=[REDACTED]", "z severity=WARN",
    ]
    out, check = shared_folder(spark, "lines"), shared_folder(spark, "check")
    run(
        logs.service_log(logs.stream_logs(spark, path))
        .writeStream.format("parquet")
        .option("checkpointLocation", check)
        .trigger(availableNow=True)
        .start(out)
    )
    assert spark.read.parquet(out).count() == 2


def test_feature_stream_equals_batch(spark, make_ticks, landing):
    import random

    from tickweave.operators import features
    from tickweave.params import MicroParams
    from tickweave.streaming import feature_stream

    rnd, rows, price = random.Random(4), [], 10.0
    for i in range(900):
        price = round(price + rnd.choice([-0.05, 0, 0, 0.05]), 2)
        side = rnd.choice(["BUY", "SELL", None, "NEUTRAL"])
        seq = i if rnd.random() < 0.8 else None
        rows.append(
            tick(rnd.choice("AB"), DAY, hk_ms(DAY, "09:30:00") + i * 700, seq, price, rnd.randrange(50),
                 None if rnd.random() < 0.3 else price * 7, direction=side)
        )
    for at in range(0, 900, 150):
        landing.add(make_ticks(rows[at : at + 150]))
    landing.add(make_ticks([tick("A", DAY, hk_ms(DAY, "09:30:00"), 0, 9.0)]))  # late
    p = MicroParams()
    once, read = collect_stream(
        spark, lambda: feature_stream.stream_features(landing.stream(), p), landing
    )
    once()
    newest = feature_stream.newest_revisions(read())
    batch = features.minute_features(make_ticks(rows), p)

    def shape(df):
        return sorted(
            tuple(round(v, 6) if isinstance(v, float) else v for v in r)
            for r in df.select(*batch.columns).collect()
        )

    assert shape(newest) == shape(batch)
    assert read().where("symbol = 'A'").agg(F.max("revision")).first()[0] == 6
