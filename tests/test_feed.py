import pytest
from tick_rows import hk_ms
from pyspark.sql import functions as F

from tickweave.functions import clock, text
from tickweave.params import parse_sessions
from tickweave.sources import feed

OPEN = 1_704_159_000_000  # 2024-01-02 09:30 local
NOW = OPEN + 5_000


def normalized(spark, rows, schema, **options):
    raw = spark.createDataFrame(rows, schema)
    return feed.normalize(raw, recv_ts_ms=F.lit(options.pop("now", NOW)), push_type="push", **options)


def test_example_record(spark):
    rows = [("HK.01211", "2024-01-02 09:30:00", 88.25, "400", 35300.0, "SELL", 9071, "20240102")]
    schema = (
        "code string, time string, price double, volume string, turnover double, "
        "ticker_direction string, sequence bigint, trading_day string"
    )
    got = normalized(spark, rows, schema).first()
    assert (got.market, got.symbol, got.seq, got.ts_ms) == ("HK", "HK.01211", 9071, OPEN)
    assert (got.recv_ts_ms, got.inserted_at_ms, got.reject_reason) == (NOW, NOW, None)


@pytest.mark.parametrize(
    "value, day, expected",
    [
        ("09:30:00", "20240102", OPEN),
        ("12:00:00", "20240102", hk_ms("20240102", "12:00:00")),
        ("16:00:00", "20240102", hk_ms("20240102", "16:00:00")),
        ("00:05:00", "20240103", hk_ms("20240103", "00:05:00")),
        ("093000", "20240102", OPEN),
        ("93000", "20240102", OPEN),
        ("20240102093000", None, OPEN),
        ("2024-01-02T01:30:00+00:00", "20240102", OPEN),
        ("2024-01-02T01:30:00Z", None, OPEN),
        ("2024/01/02 09:30:00.250", None, OPEN + 250),
        ("2024-01-02 09:30", None, OPEN),
        ("1704159000", None, OPEN),
        ("1704159000123", None, OPEN + 123),
        ("09:30:00", None, OPEN),
        ("09:30:00", "2024/1/2", OPEN),
        ("250000", "20240102", None),
        ("9:30", "20240102", None),
        ("no such time", "20240102", None),
        ("", "20240102", None),
        (None, "20240102", None),
    ],
)
def test_time_text(spark, value, day, expected):
    got = normalized(
        spark, [("A.1", value, day)], "code string, time string, trading_day string"
    ).first()
    assert got.ts_ms == expected
    assert got.reject_reason == (None if expected is not None else "bad_time")


@pytest.mark.parametrize(
    "value, expected",
    [
        (93000, OPEN),
        (1_704_159_000, OPEN),
        (1_704_159_000_123, OPEN + 123),
        (20240102093000, 20240102093000),
        (12_345_678, 12_345_678_000),
    ],
)
def test_time_number(spark, value, expected):
    got = normalized(
        spark, [("A.1", value, "20240102")], "code string, time bigint, trading_day string"
    ).first()
    assert got.ts_ms == expected


def test_zone_shift_is_repaired(spark):
    got = normalized(
        spark,
        [("A.1", str(OPEN + 28_800_000), "20240102")],
        "code string, time string, trading_day string",
        now=OPEN,
    ).first()
    assert got.ts_ms == OPEN


def test_one_bad_row_does_not_spoil_the_batch(spark):
    out = normalized(
        spark,
        [("A.1", "09:30:00"), ("A.1", "later"), (None, "09:30:00"), ("", "09:30:00")],
        "code string, time string",
    )
    assert feed.accepted(out).count() == 1
    counts = {r.reject_reason: r["count"] for r in feed.rejects(out).groupBy("reject_reason").count().collect()}
    assert counts == {"bad_time": 1, "missing_code": 2}


def test_aliases_and_lenient_values(spark):
    schema = (
        "code string, symbol string, time string, ts bigint, price double, volume string, "
        "direction string, sequence bigint, seq bigint, tick_type string"
    )
    rows = [
        ("", "US.X", None, OPEN, float("nan"), "100.0", "  ", 0, 7, " T "),
        (None, "Y", "", OPEN, 1.5, " 12 ", None, 0, None, None),
        (None, "Z", "", OPEN, 1.5, "x", None, 0, 0, None),
    ]
    a, b, c = normalized(spark, rows, schema).orderBy("symbol").collect()
    assert (a.market, a.symbol, a.ts_ms, a.price, a.volume, a.direction, a.seq, a.tick_type) == (
        "US", "US.X", OPEN, None, None, None, 7, "T",
    )
    assert (b.market, b.volume, b.seq, b.trading_day) == ("HK", 12, None, "20240102")
    assert (c.volume, c.seq) == (None, 0)


def test_explicit_day_wins(spark):
    got = normalized(
        spark,
        [("A.1", "2024-02-16 12:10:00", "2026-02-16")],
        "code string, time string, date string",
    ).first()
    assert got.trading_day == "20260216"


def test_same_result_in_other_default_zone(spark):
    raw = [("A.1", "2024-01-02 09:30:00")]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert normalized(spark, raw, "code string, time string").first().ts_ms == OPEN


def test_session_spec():
    spec = parse_sessions("09:30-12:00, 13:00-16:00")
    assert [(s.start_sec, s.end_sec, s.label) for s in spec] == [
        (34200, 43200, "09:30-12:00"),
        (46800, 57600, "13:00-16:00"),
    ]
    for bad in ("", "0930", "12:00-09:30", "25:00-26:00", "9-10"):
        with pytest.raises(ValueError):
            parse_sessions(bad)


def test_session_index_edges(spark):
    spec = parse_sessions("09:30-12:00,13:00-16:00")
    cases = {
        ("20240102", "09:29:59"): None,
        ("20240102", "09:30:00"): 0,
        ("20240102", "11:59:59"): 0,
        ("20240102", "12:00:00"): None,
        ("20240102", "13:00:00"): 1,
        ("20240102", "16:00:00"): None,
        ("20240106", "10:00:00"): None,
    }
    df = spark.createDataFrame([(hk_ms(d, c), d + c) for d, c in cases], "t bigint, k string")
    got = {r.k: r.s for r in df.select("k", clock.session_index("t", spec).alias("s")).collect()}
    assert got == {d + c: v for (d, c), v in cases.items()}


def test_text_rules(spark):
    df = spark.createDataFrame([("..a b/c..",), ("???",), ("HK.00700",)], "s string")
    assert [r[0] for r in df.select(text.file_stem("s")).collect()] == ["a_b_c", "UNKNOWN", "HK.00700"]
    line = spark.createDataFrame(
        [("id 12345678:abcdefghij_klmnopqrst x TOKEN = q1 queue=3/9\nlag=2.5 write:7",)], "s string"
    )
    got = line.select(
        text.redact("s"), text.kpi_lag("s"), text.kpi_persisted("s"), text.kpi_queue("s")
    ).first()
    assert got[0].startswith("id [REDACTED_TOKEN] x token=[REDACTED] queue=3/9")
    assert tuple(got)[1:] == ("2.5s", "7/min", "3/9")
