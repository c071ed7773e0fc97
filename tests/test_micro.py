import dataclasses
import random

from tick_rows import hk_ms, tick

from tickweave.operators import events, features, levels
from tickweave.params import MicroParams

DAY = "20260216"
P = MicroParams()


def random_ticks(make_ticks, n=600, seed=1, **other):
    rnd = random.Random(seed)
    start = hk_ms(DAY, "09:30:00")
    rows = []
    for i in range(n):
        price = round(10 + rnd.randrange(-3, 4) * 0.01, 2)
        ts = start + rnd.randrange(40) * 60_000 + rnd.randrange(3) * 1000
        rows.append(tick("HOT", DAY, ts, i, price, rnd.randrange(1, 9), None, **other))
    return rows, make_ticks(rows)


def test_tick_rule_equals_a_walk(make_ticks):
    rows, df = random_ticks(make_ticks, direction=None)
    got = {r.seq: r.tick_sign for r in features.tick_sides(df, P).collect()}
    last_price, sign = None, None
    for r in sorted(rows, key=lambda r: (r["ts_ms"], r["seq"])):
        if last_price is not None and r["price"] != last_price:
            sign = 1.0 if r["price"] > last_price else -1.0
        last_price = r["price"]
        assert got[r["seq"]] == sign


def test_minute_features(make_ticks):
    t = hk_ms(DAY, "09:30:00")
    rows = [
        tick("A", DAY, t, 1, 10.0, 100, 1000.0, direction="BUY"),
        tick("A", DAY, t + 10, 2, 10.05, 50, None, direction=None),
        tick("A", DAY, t + 20, 3, 10.05, 50, None, direction=None),
        tick("A", DAY, t + 59_999, 4, 9.9, 100, 990.0, direction="NEUTRAL"),
        tick("A", DAY, t + 60_000, 5, 9.9, 10, 99.0, direction=None),
        tick("A", DAY, t + 60_001, 6, None, 10, 99.0, direction=None),
    ]
    a, b = features.minute_features(make_ticks(rows), P).orderBy("ts_min_ms").collect()
    assert (a.ticks, a.volume, a.open, a.high, a.low, a.close) == (4, 300, 10.0, 10.05, 9.9, 9.9)
    assert (a.buy_volume, a.sell_volume) == (200, 100)  # unchanged price carries the buy on
    assert a.turnover == 1000.0 + 10.05 * 50 * 2 + 990.0
    assert a.jump_count == 2
    assert (b.ticks, b.sell_volume, b.jump_count) == (1, 10, 0)


def test_profile_levels(make_ticks):
    t = hk_ms(DAY, "10:00:00")
    volumes = {10.0: 5, 10.1: 40, 10.2: 10, 10.3: 40, 10.4: 1, 10.5: 4}
    rows = [tick("A", DAY, t + i, i, p, v) for i, (p, v) in enumerate(volumes.items())]
    profile = levels.day_profile(make_ticks(rows), P)
    got = levels.levels_daily(profile, P).first()
    assert round(got.poc, 6) == 10.1  # equal volumes: the lower price
    assert (round(got.val, 6), round(got.vah, 6)) == (10.1, 10.3)
    assert [round(n.price, 6) for n in got.hvn] == [10.1, 10.3]
    assert [round(n.price, 6) for n in got.lvn] == [10.2, 10.4]
    assert got.total_volume == 100 and got.close_strength_score == 1.0


def test_levels_before(spark):
    feats = spark.createDataFrame([("A", "3"), ("A", "9"), ("B", "1")], "symbol string, trading_day string")
    lev = spark.createDataFrame([("A", "1", 5.0), ("A", "3", 6.0)], "symbol string, trading_day string, poc double")
    got = {(r.symbol, r.trading_day): r.poc for r in features.levels_before(feats, lev).collect()}
    assert got == {("A", "3"): 5.0, ("A", "9"): 6.0}


def test_cooldown_equals_a_walk(spark):
    rnd = random.Random(4)
    rows, t = [], 0
    for i in range(400):
        t += rnd.choice([1000, 60_000, 400_000])
        rows.append((t, "A", f"T{i}", "WARN", 1.0, rnd.choice(["k1", "k2"]), 300, "{}", 0))
    df = spark.createDataFrame(
        rows,
        "ts_ms bigint, symbol string, event_type string, severity string, score double, "
        "dedup_key string, cooldown_sec int, payload_json string, created_at_ms bigint",
    )
    got = {(r.dedup_key, r.ts_ms): r.suppressed_count for r in events.apply_cooldown(df).collect()}
    want, last, dropped = {}, {}, {}
    for ts, _, _, _, _, key, *_ in rows:
        if key not in last or ts - last[key] >= 300_000:
            want[key, ts] = dropped.get(key, 0)
            last[key], dropped[key] = ts, 0
        else:
            dropped[key] = dropped.get(key, 0) + 1
    assert got == want


def test_push_policy(spark):
    rows = [
        ("LVN_BREAKOUT_UP", "ALERT", 1.0), ("ABSORPTION_BUY", "WARN", 75.0),
        ("ABSORPTION_SELL", "WARN", 74.9), ("VALUE_REJECTION", "WARN", 70.0),
        ("OPEN_IMBALANCE", "WARN", 0.0), ("RANGE_COMPRESSION", "INFO", 100.0),
    ]
    df = spark.createDataFrame(rows, "event_type string, severity string, score double")
    assert sorted(r.event_type for r in events.pushed(df).collect()) == [
        "ABSORPTION_BUY", "LVN_BREAKOUT_UP", "OPEN_IMBALANCE", "VALUE_REJECTION",
    ]


def test_latest_before(spark):
    later = spark.createDataFrame([("A", "d", 100), ("A", "d", 200), ("B", "d", 100)], "symbol string, trading_day string, ts_ms bigint")
    earlier = spark.createDataFrame([("A", "d", 40), ("A", "d", 100), ("A", "d", 120)], "symbol string, trading_day string, ts_ms bigint")
    got = sorted((r.ts_ms, r.matched_ts_ms) for r in events.latest_before(later, earlier, 90).collect())
    assert got == [(100, 40), (200, 120)]


def test_bad_levels_mode(make_ticks):
    import pytest

    _, df = random_ticks(make_ticks, 20)
    lev = levels.levels_daily(levels.day_profile(df, P), P)
    feats = features.minute_features(df, P)
    with pytest.raises(ValueError):
        features.with_levels(feats, lev, dataclasses.replace(P, levels_mode="x"))
    placed = features.with_levels(feats, lev, P)
    assert placed.where("in_value_area + above_vah + below_val <> 1").count() == 0


def test_micro_tables_by_day(spark, make_ticks):
    from tickweave.plans import commands
    from tickweave.session import shared_folder
    from tickweave.sources.store import TickStore

    rnd = random.Random(8)
    rows = []
    for day in ("20260216", "20260217"):
        price = 10.0
        for i in range(1500):
            price = round(max(5.0, price + rnd.choice([-0.05, 0, 0, 0.05])), 2)
            ts = hk_ms(day, "09:30:00") + i * 6000
            rows.append(tick("A", day, ts, i, price, rnd.randrange(1, 50), None, direction=None))
    store = TickStore(spark, shared_folder(spark, "store"))
    store.append_ticks(make_ticks(rows))
    commands.build_micro_tables(store, P, 1)
    read = lambda n: sorted(
        map(str, commands.micro_table(store, n).drop("hvn", "lvn").collect())
    )
    first = {n: read(n) for n in ("features_1m", "levels_daily", "events")}
    assert len(first["levels_daily"]) == 2 and len(first["events"]) > 0
    wanted = {"dist_to_poc", "in_value_area", "above_vah", "below_val", "compression_score", "release_score"}
    assert wanted <= set(commands.micro_table(store, "features_1m").columns)
    commands.build_micro_tables(store, P, 1, ["20260217"])
    assert {n: read(n) for n in first} == first
    earlier = dataclasses.replace(P, levels_mode="prev_day")
    commands.build_micro_tables(store, earlier, 1)
    whole = {n: read(n) for n in first}
    assert whole["events"] != first["events"]
    for day in ("20260216", "20260217"):
        commands.build_micro_tables(store, earlier, 1, [day])
    assert {n: read(n) for n in first} == whole
    keys = commands.micro_table(store, "events").select("ts_ms", "symbol", "event_type", "dedup_key")
    assert keys.count() == keys.distinct().count()
