import dataclasses
import json

import pytest
from tick_rows import hk_ms, tick
from pyspark.sql import functions as F

from tickweave.operators import quality, stats
from tickweave.params import QualityParams
from tickweave.plans import commands
from tickweave.schema import GAPS
from tickweave.session import shared_folder
from tickweave.sources import calendar

P = dataclasses.replace(QualityParams(), active_min_ticks=2, stall_warn_sec=3.0)
A, B = 1_708_056_600_000, 1_708_056_605_000
DAY = "20260216"


@pytest.fixture
def two_ticks(make_ticks):
    return make_ticks(
        [
            tick("HK.00700", DAY, A, 1, 300.0, 100, 30000.0),
            tick("HK.00700", DAY, B, 2, 301.0, 200, 60200.0),
        ]
    )


@pytest.fixture
def one_gap(spark):
    return spark.createDataFrame([(DAY, "HK.00700", A, B, 5.0, B, "hard_gap", "{}")], GAPS)


def test_report(two_ticks, one_gap):
    got = quality.daily_report(two_ticks, one_gap, P, B + 1000).first()
    assert (got.total_rows, got.hard_gaps_total, got.quality_grade) == (2, 1, "B")
    assert (got.soft_stalls_total, got.duration_sec, got.last_tick_age_sec) == (0, 5.0, 1.0)
    assert got.rows_per_symbol[0].symbol == "HK.00700" and got.rows_per_symbol[0].rows == 2
    assert got.start_local == "2024-02-16 12:10:00" and got.day_dashed == "2026-02-16"
    assert got.warnings == []


def test_report_of_a_day_without_data(spark, two_ticks, one_gap):
    days = quality.requested_days(spark, [DAY, "20260217"])
    rows = {r.trading_day: r for r in quality.daily_report(two_ticks, one_gap, P, B, days=days).collect()}
    empty = rows["20260217"]
    assert (empty.total_rows, empty.quality_grade, empty.warnings) == (0, "D", ["db_not_found"])
    assert (empty.start_local, empty.last_tick_age_sec) == ("n/a", None)


def test_report_json(spark, two_ticks, one_gap):
    path = shared_folder(spark, "report")
    report = quality.daily_report(two_ticks, one_gap, P, B)
    quality.write_reports(report, path)
    quality.write_reports(report, path)  # replaces the day
    line = spark.read.text(f"{path}/trading_day={DAY}").collect()
    assert len(line) == 1
    body = json.loads(line[0][0])
    assert body["volume"]["total_rows"] == 2
    assert body["gaps"]["gaps_by_symbol"][0]["largest_gap_sec"] == 5.0
    assert body["conclusion"]["quality_grade"] == "B"
    row = quality.daily_quality_rows(report, B, "h").first()
    assert json.loads(row.summary_json)["total_rows"] == 2


@pytest.mark.parametrize(
    "rows, total, largest, stalls, expected",
    [
        (0, 0.0, 0.0, 0.0, "D"),
        (1, 0.0, 120.001, 0.0, "D"),
        (1, 900.001, 1.0, 0.0, "D"),
        (1, 900.0, 120.0, 0.0, "C"),
        (1, 1.0, 60.001, 0.0, "C"),
        (1, 300.001, 1.0, 0.0, "C"),
        (1, 300.0, 60.0, 0.0, "B"),
        (1, 0.0, 0.0, 120.001, "B"),
        (1, 0.0, 0.0, 120.0, "A"),
    ],
)
def test_grade(spark, rows, total, largest, stalls, expected):
    got = spark.range(1).select(
        quality.grade(F.lit(rows), F.lit(total), F.lit(largest), F.lit(stalls))
    )
    assert got.first()[0] == expected


def verdict(spark, ticks, gaps, now, **options):
    days = quality.requested_days(spark, [DAY])
    got = quality.validate(days, ticks, gaps, now, **options).first()
    return got.status, got.reasons, got.warnings


def test_validate(spark, two_ticks, one_gap):
    none = one_gap.where("false")
    assert verdict(spark, two_ticks, none, B) == ("PASS", [], [])
    assert verdict(spark, two_ticks, none, B - 60_000) == ("PASS", [], [])
    assert verdict(spark, two_ticks, none, B - 60_001) == (
        "WARN", [], ["ticks_max_ts_slightly_in_future"],
    )
    assert verdict(spark, two_ticks, none, B - 300_001)[0] == "FAIL"
    assert verdict(spark, two_ticks, one_gap, B) == ("PASS", [], [])
    assert verdict(spark, two_ticks, one_gap, B, strict=True) == (
        "WARN", [], ["strict_mode_gap_observed"],
    )
    long = one_gap.withColumn("gap_sec", F.lit(60.001))
    assert verdict(spark, two_ticks, long, B, strict=True) == (
        "FAIL", ["strict_mode_gap_threshold_exceeded"], [],
    )
    assert verdict(spark, two_ticks, none, B, gaps_table=False) == (
        "WARN", [], ["gaps_table_missing"],
    )
    assert verdict(spark, two_ticks.where("false"), none, B)[:2] == ("FAIL", ["db_not_found"])
    assert verdict(spark, two_ticks.where("false"), one_gap, B)[1] == [
        "ticks_count_is_zero", "ticks_max_ts_missing",
    ]


def test_status_and_commands(spark, make_ticks, two_ticks, one_gap):
    more = two_ticks.unionByName(
        make_ticks([tick("HK.00981", DAY, A + 2000, 1, 12.0, 300, 3600.0)])
    )
    top = commands.db_top_symbols(more, 30, "volume", 2, DAY).orderBy("rank").collect()
    assert [(r.symbol, r.volume) for r in top] == [("HK.00700", 300), ("HK.00981", 300)]
    assert commands.db_top_symbols(more, 30, "turnover", 1).first().turnover == 90200.0
    with pytest.raises(ValueError):
        stats.top_symbols(more, metric="price")
    rows = quality.status(more, one_gap, B, ["HK.00981"]).collect()
    assert [(r.total_rows, r.rank, r.symbol, r.gaps_total) for r in rows] == [(3, 2, "HK.00981", 1)]
    # the name filter comes after the limit, unless asked otherwise
    assert quality.status(more, one_gap, B, ["HK.00981"], top_n=1).first().symbol is None
    pre = quality.status(more, one_gap, B, ["HK.00981"], top_n=1, pre_filter=True).first()
    assert pre.symbol == "HK.00981"
    assert commands.db_symbol(more, "HK.00700", 1).first().seq == 2
    assert {r.symbol: r.rows for r in commands.db_symbols(more, B).collect()} == {
        "HK.00700": 2, "HK.00981": 1,
    }


def test_lower_rank_percentiles(spark):
    import random

    rnd = random.Random(3)
    data = [(g, rnd.choice([5, 7, rnd.randrange(10_000)])) for g in "aab" for _ in range(400)]
    data.append(("one", 42))
    df = spark.createDataFrame(data, "g string, v bigint")
    probs = (0.0, 0.5, 0.95, 1.0)
    got = {
        (r.g, r.p): r.value
        for r in stats.lower_rank_percentiles(df, ["g"], "v", probs, 250.0).collect()
    }
    for g in ("a", "b", "one"):
        values = sorted(v for k, v in data if k == g)
        for p in probs:
            assert got[g, p] == values[int((len(values) - 1) * p)]


@pytest.mark.parametrize(
    "day, clock, listed, expected",
    [
        ("20260213", "10:00:00", (), ("open", True, True)),
        ("20260213", "09:10:00", (), ("pre-open", True, False)),
        ("20260213", "08:59:59", (), ("after-hours", True, False)),
        ("20260213", "12:00:00", (), ("lunch-break", True, False)),
        ("20260213", "16:00:00", (), ("after-hours", True, False)),
        ("20260214", "10:00:00", (), ("after-hours", False, False)),
        ("20260213", "10:00:00", ("20260213",), ("holiday-closed", False, False)),
        ("20260214", "10:00:00", ("20260214",), ("after-hours", False, False)),
    ],
)
def test_market_state(spark, day, clock, listed, expected):
    df = spark.createDataFrame([(hk_ms(day, clock),)], "t bigint")
    days = spark.createDataFrame([(d,) for d in listed], "trading_day string")
    got = calendar.with_market_state(df, "t", days).first()
    assert (got.market_mode, got.is_trading_day, got.is_trading_session) == expected
    assert got.market_day == day


def test_holiday_file(spark, tmp_path):
    (tmp_path / "days.txt").write_text("# list\n2026-02-13,Spring\n 20260214 \n\n2026/2/1\nx\n")
    listed = calendar.read_holidays(spark, str(tmp_path / "days.txt"))
    both = calendar.merge_holidays(listed, ["2026-02-17", "20260214"])
    assert sorted(r[0] for r in both.collect()) == ["20260213", "20260214", "20260217"]
