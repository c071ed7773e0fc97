import dataclasses
import random

import pytest
from tick_rows import hk_ms
from pyspark.sql import functions as F

from tickweave.operators import folds, health
from tickweave.params import HealthParams
from tickweave.schema import HEALTH

P = HealthParams(stall_sec=30, queue_threshold_rows=20)
DAY_MS = 86_400_000


def metric(spark, **values):
    now = 1_000_000_000
    row = {
        "instance": "a", "minute_ms": now, "started_at_ms": now - 80_000, "queue_size": 0,
        "persisted_rows": 0, "queue_in": 0, "queue_out": 0, "push_rows": 0, "poll_enqueued": 0,
        "poll_fetched": 0, "poll_seq_advanced": 0, "upstream_at_ms": now - 1000,
        "commit_at_ms": None, "worker_alive": True,
    }
    row.update(values)
    schema = ", ".join(
        f"{k} {'string' if k == 'instance' else 'boolean' if k == 'worker_alive' else 'bigint'}"
        for k in row
    )
    return spark.createDataFrame([tuple(row.values())], schema)


@pytest.mark.parametrize(
    "values, expected",
    [
        ({"queue_in": 10, "worker_alive": False}, "worker_dead"),
        ({"queue_in": 10, "commit_at_ms": 1_000_000_000 - 40_000}, "no_commit"),
        ({"queue_in": 10, "queue_out": 5, "commit_at_ms": 1_000_000_000 - 5_000}, None),
        ({"poll_fetched": 50, "worker_alive": False}, None),
        ({"queue_size": 5, "worker_alive": False}, None),
        ({"queue_size": 5, "queue_in": 10, "worker_alive": False}, "worker_dead"),
        ({"queue_in": 10}, "no_commit"),
        ({"queue_in": 10, "upstream_at_ms": None}, None),
        ({"queue_size": 20, "upstream_at_ms": None}, "no_commit"),
        ({"queue_in": 10, "persisted_rows": 3}, None),
    ],
)
def test_write_stall(spark, values, expected):
    got = health.write_stalls(metric(spark, **values), P).first()
    assert got.reason == expected and got.stalled == (expected is not None)


def test_previous_and_runs_over_slices(spark):
    rnd = random.Random(5)
    rows, times = [], {}
    for key in ("a", "b"):
        t = 0
        for _ in range(300):
            t += rnd.choice([60_000, 3_600_000, DAY_MS * 2])
            rows.append((key, t, rnd.random() < 0.8))
    df = spark.createDataFrame(rows, "k string, t bigint, f boolean")
    got = health.run_lengths(df, ["k"], "t", F.col("f"), "run")
    prev = {
        (r.k, r.t): r.prev for r in health.with_previous(df, ["k"], "t", ["t", "f"]).collect()
    }
    runs = {(r.k, r.t): r.run for r in got.collect()}
    for key in ("a", "b"):
        length, last = 0, None
        for k, t, f in rows:
            if k != key:
                continue
            length = length + 1 if f else 0
            assert runs[k, t] == length
            assert (prev[k, t] and tuple(prev[k, t])) == last
            last = (t, f)
    del times


class PlainAlerts:
    """The alert rule told differently: a list of sent times and flags per incident."""

    def __init__(self, params):
        self.p, self.open = params, {}

    def cooldown(self, sev):
        return {"ALERT": self.p.alert_cadence_sec, "WARN": self.p.warn_cadence_sec}.get(
            sev, max(30, self.p.alert_cooldown_sec)
        )

    def feed(self, key, at, sev, kind):
        if kind == "resolve":
            self.open.pop(key, None)
            return "state_recovered"
        wait = self.cooldown(sev)
        ladder = sorted(
            {0} | {s for s in self.p.escalation_steps if s == 0 or s >= wait}
            | ({wait} if sev in ("WARN", "ALERT") else set())
        )
        rank = ["OK", "WARN", "ALERT"].index(sev)
        inc = self.open.get(key)
        if inc is None:
            self.open[key] = {"since": at, "sent": at, "rank": rank, "rung": 1}
            if len(ladder) == 1:
                self.open[key]["rung"] = 1
            return "new"
        if rank > inc["rank"]:
            inc.update(rank=rank, sent=at)
            return "severity_upgraded"
        waited = (at - inc["sent"]) / 1000
        if inc["rung"] < len(ladder) and (at - inc["since"]) / 1000 >= ladder[inc["rung"]]:
            if waited >= wait:
                inc["rung"] += 1
                inc["sent"] = at
                return f"escalation_step_{ladder[inc['rung'] - 1]}s"
        if waited >= wait:
            inc["sent"] = at
            return "cooldown_elapsed"
        return "cooldown_active"


def test_alert_decisions_against_a_plain_model(spark):
    rnd = random.Random(11)
    rows, at = [], 0
    for i in range(1500):
        at += rnd.choice([0, 1000, 20_000, 100_000, 400_000])
        kind = "resolve" if rnd.random() < 0.05 else "alert"
        sev = "OK" if kind == "resolve" else rnd.choice(["OK", "WARN", "WARN", "ALERT"])
        rows.append((at, i, kind, "C", "", rnd.choice(["f1", "f2", "f3"]), "d", sev, None, f"e{i}"))
    schema = (
        "created_at_ms bigint, ord bigint, kind string, code string, key string, "
        "fingerprint string, trading_day string, severity string, sid string, eid string"
    )
    params = HealthParams(alert_cooldown_sec=45, escalation_steps=(0, 100, 600, 1800))
    got = {
        r.ord: (r.reason, r.emitted)
        for r in folds.alert_decisions(spark.createDataFrame(rows, schema), params).collect()
    }
    model = PlainAlerts(params)
    for at, i, kind, _, _, fp, _, sev, _, _ in rows:
        reason = model.feed(fp, at, sev, kind)
        assert got[i] == (reason, reason != "cooldown_active"), i


def test_unknown_fingerprint_and_incident_ids(spark):
    schema = (
        "created_at_ms bigint, ord bigint, kind string, code string, key string, "
        "fingerprint string, trading_day string, severity string, sid string, eid string"
    )
    rows = [
        (0, 1, "alert", "", "", " ", "d", "ALERT", "s1", "e1"),
        (1000, 2, "alert", "", None, None, "d", "ALERT", "s2", "e2"),
        (2000, 3, "resolve", "", "", "", "d", "OK", None, None),
        (3000, 4, "alert", "", "", "", "d", "WARN", None, "e4"),
    ]
    out = folds.alert_decisions(spark.createDataFrame(rows, schema), P).orderBy("ord").collect()
    assert {r.fingerprint for r in out} == {"unknown"}
    assert [r.reason for r in out] == ["new", "cooldown_active", "state_recovered", "new"]
    assert [(r.incident_eid, r.incident_sid) for r in out][2] == ("e1", "s1")


def snapshot(created, **values):
    row = {
        "instance": "a", "sid": f"s{created}", "created_at_ms": created, "trading_day": "20260213",
        "db_rows": 10, "drift_sec": 1.0, "queue_size": 0, "queue_maxsize": 100,
        "push_rows_per_min": 0, "poll_fetched": 0, "poll_accepted": 0,
        "persisted_rows_per_min": 100, "dropped_duplicate": 0, "symbols": [],
    }
    row.update(values)
    return tuple(row[n] for n in HEALTH.fieldNames())


def test_fixed_interval_emission(spark):
    start = hk_ms("20260213", "18:00:00")
    rows = [snapshot(start), snapshot(start + 601_000), snapshot(start + 700_000)]
    df = spark.createDataFrame(rows, HEALTH)
    fixed = dataclasses.replace(P, fixed_interval_sec=600)
    emitted = lambda p: [
        r.reason
        for r in folds.health_emissions(health.assess_health(df, p), p)
        .orderBy("created_at_ms")
        .collect()
    ]
    assert emitted(fixed) == ["bootstrap", "ok_cadence", "ok_cooldown"]
    assert emitted(P) == ["bootstrap", "after_hours_once", "after_hours_once"]


def test_assessment(spark):
    t = hk_ms("20260213", "10:00:00")
    old = [("X", 700.0, 1, 0), ("Y", 1000.0, 1, 0), ("Z", 1000.0, 1, 0)]
    quiet = {"persisted_rows_per_min": 0, "symbols": old}
    rows = [
        snapshot(t, queue_size=60),
        snapshot(t + 60_000, persisted_rows_per_min=29),
        snapshot(t + 120_000, persisted_rows_per_min=0, queue_size=1),
        *[snapshot(t + (3 + i) * 60_000, **quiet) for i in range(3)],
        snapshot(t + 360_000, drift_sec=-120.0),
        snapshot(hk_ms("20260213", "12:30:00"), queue_size=5, persisted_rows_per_min=0),
        snapshot(hk_ms("20260214", "09:10:00"), queue_size=90),
    ]
    out = health.assess_health(spark.createDataFrame(rows, HEALTH), P).orderBy("created_at_ms")
    got = [(r.market_mode, r.finding, r.severity) for r in out.collect()]
    assert got == [
        ("open", "degraded", "WARN"),
        ("open", "degraded", "WARN"),
        ("open", "write_stopped", "WARN"),
        ("open", "normal", "OK"),
        ("open", "normal", "OK"),
        ("holiday-closed", "normal", "OK"),
        ("open", "degraded", "WARN"),
        ("lunch-break", "backlog", "WARN"),
        ("after-hours", "normal", "OK"),
    ]


def test_mute_spares_alerts(spark):
    rows = spark.createDataFrame(
        [("a", t, s) for t in (5, 10, DAY_MS * 2) for s in ("OK", "ALERT")],
        "instance string, created_at_ms bigint, severity string",
    )
    mutes = spark.createDataFrame([("a", 10, DAY_MS * 2)], "instance string, from_ms bigint, until_ms bigint")
    left = {(r.created_at_ms, r.severity) for r in health.drop_muted(rows, mutes).collect()}
    assert left == {(5, "OK"), (5, "ALERT"), (10, "ALERT"), (DAY_MS * 2, "OK"), (DAY_MS * 2, "ALERT")}


@pytest.mark.parametrize("limit", [1, 4])
def test_admission(spark, limit):
    rnd = random.Random(limit)
    rows, t = [], 0
    for i in range(800):
        t += rnd.choice([0, 500, 9_000, 30_000, 200_000])
        rows.append((rnd.choice("xxxy"), i, t))
    df = spark.createDataFrame(rows, "k string, i bigint, t bigint")
    got = {
        r.i: (r.admitted, r.delay_ms)
        for r in folds.admissions(df, ["k"], "t", limit, 60.0, ["i"]).collect()
    }
    hits = {"x": [], "y": []}
    for k, i, t in rows:
        live = [h for h in hits[k] if t - h < 60_000]
        if len(live) < limit:
            live.append(t)
            want = (True, 0)
        else:
            want = (False, 60_000 - (t - live[0]))
        hits[k] = live
        assert got[i] == want


def test_sequence_advance_over_slices(spark):
    rnd = random.Random(2)
    rows = [("s", i * 10_000_000, rnd.randrange(100) if rnd.random() < 0.9 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "symbol string, fetched_at_ms bigint, max_seq bigint")
    got = {r.fetched_at_ms: r.advanced for r in health.sequence_advance(df).collect()}
    best = None
    for _, t, seq in rows:
        want = seq is not None and (best is None or seq > best)
        assert got[t] == want
        best = seq if want else best
