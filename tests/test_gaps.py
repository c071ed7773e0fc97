import dataclasses
import random

import pytest
from tick_rows import hk_ms, tick

from tickweave.operators import gaps
from tickweave.params import QualityParams, parse_sessions

P = QualityParams(active_min_ticks=3)
DAY = "20260216"


def at(*clocks, day=DAY):
    return [hk_ms(day, c) for c in clocks]


def found(make_ticks, times, params=P, symbol="HK.00700", day=DAY):
    rows = [tick(symbol, day, t, i) for i, t in enumerate(times)]
    out = gaps.hard_gaps(make_ticks(rows), params, 1).orderBy("gap_start_ts_ms").collect()
    return [(r.gap_start_ts_ms, r.gap_end_ts_ms, r.gap_sec) for r in out]


def test_active_gap(make_ticks):
    t = at("09:30:00", "09:30:01", "09:30:02", "09:30:20")
    assert found(make_ticks, t) == [(t[2], t[3], 18.0)]


def test_inactive_and_off_session(make_ticks):
    ten = dataclasses.replace(P, active_min_ticks=10)
    two = dataclasses.replace(P, active_min_ticks=2)
    assert found(make_ticks, at("09:30:00", "09:30:25"), ten) == []
    assert found(make_ticks, at("08:00:00", "08:00:25"), two) == []


def test_edges(make_ticks):
    one = dataclasses.replace(P, active_min_ticks=1)
    assert found(make_ticks, at("11:59:50", "12:00:05"), one) == []  # the end is exclusive
    assert found(make_ticks, at("11:59:00", "13:00:30"), one) == []  # lunch
    sat = [hk_ms("20260214", "10:00:00"), hk_ms("20260214", "10:01:00")]
    assert found(make_ticks, sat, one, day="20260214") == []
    t = at("10:00:00", "10:00:10")
    assert found(make_ticks, t, one) == []  # exactly the threshold
    t = at("10:00:00", "10:00:01", "10:00:02", "10:06:00")
    assert found(make_ticks, t) == []  # longer than the window: no longer active
    t = at("10:00:00", "10:00:00", "10:00:00", "10:00:20")
    assert found(make_ticks, t) == []  # equal times count once


def test_single_tick_activity_spans_days(make_ticks):
    one = dataclasses.replace(P, active_min_ticks=1)
    a, b = hk_ms("20260216", "14:00:00"), hk_ms("20260217", "13:30:00")
    assert found(make_ticks, [a, b], one) == [(a, b, (b - a) / 1000.0)]


def replay(times_by_symbol, params, threshold):
    """The rule as a plain walk over ordered times."""
    sessions = parse_sessions(params.sessions)

    def session(ts):
        ms = (ts + 8 * 3_600_000) % 86_400_000
        if ((ts + 8 * 3_600_000) // 86_400_000 + 3) % 7 >= 5:
            return None
        for i, s in enumerate(sessions):
            if s.start_sec * 1000 <= ms < s.end_sec * 1000:
                return i
        return None

    out = set()
    for symbol, times in times_by_symbol.items():
        last, recent = None, []
        for ts in sorted(times):
            recent = [r for r in recent if r >= ts - params.window_ms]
            if last is not None and ts > last and len(recent) + 1 >= params.active_min_ticks:
                if session(last) is not None and session(last) == session(ts):
                    if (ts - last) / 1000.0 > threshold:
                        out.add((symbol, last, ts, len(recent) + 1))
            if last is None or ts > last:
                last = ts
                recent.append(ts)
    return out


@pytest.mark.parametrize("min_ticks", [1, 4])
@pytest.mark.parametrize("slice_ms", [60_000, 600_000])
def test_slices_equal_a_walk(make_ticks, min_ticks, slice_ms):
    rnd = random.Random(min_ticks * 7 + slice_ms)
    start = hk_ms("20260216", "09:00:00")
    times = {}
    for symbol, n in (("HOT", 1500), ("A", 60), ("B", 3)):
        spread = 26 * 3_600_000
        times[symbol] = [start + rnd.randrange(spread // 1000) * 1000 for _ in range(n)]
        times[symbol] += rnd.choices(times[symbol], k=n // 3)
    params = dataclasses.replace(
        P, active_min_ticks=min_ticks, gap_threshold_sec=40.0, slice_ms=slice_ms,
        active_window_sec=45,
    )
    rows = [
        tick(s, "20260216" if t < start + 15 * 3_600_000 else "20260217", t, i)
        for s, ts in times.items()
        for i, t in enumerate(ts)
    ]
    got = gaps.hard_gaps(make_ticks(rows), params, 1).collect()
    import json

    assert {
        (r.symbol, r.gap_start_ts_ms, r.gap_end_ts_ms, json.loads(r.meta_json)["active_count"])
        for r in got
    } == replay(times, params, 40.0)


def test_stalls_report_and_live(make_ticks):
    params = dataclasses.replace(P, active_min_ticks=2, stall_warn_sec=3.0)
    t = at("10:00:00", "10:00:05", "10:00:20")
    ticks = make_ticks([tick("A", DAY, x, i) for i, x in enumerate(t)])
    report = gaps.soft_stalls(ticks, params)
    assert sorted(r.stall_sec for r in report.collect()) == [5.0, 15.0]  # a hard gap is one too
    live = gaps.soft_stalls(ticks, params, live=True)
    assert [r.stall_sec for r in live.collect()] == [5.0]
    totals = gaps.stall_totals(report).first()
    assert (totals.soft_stalls_total, totals.soft_stalls_total_sec, totals.largest_stall_sec) == (
        2, 20.0, 15.0,
    )
    assert [r.stall_sec for r in gaps.top_stalls(report, 1).collect()] == [15.0]


def test_evidence_text(make_ticks):
    t = at("09:30:00", "09:30:01", "09:30:02", "09:30:20")
    rows = [tick("A", DAY, x, i) for i, x in enumerate(t)]
    got = gaps.hard_gaps(make_ticks(rows), P, 1).first().meta_json
    assert got == (
        f'{{"prev_ts_ms":{t[2]},"curr_ts_ms":{t[3]},"gap_threshold_sec":10.0,'
        '"active_window_sec":300,"active_min_ticks":3,"active_count":4,"session":"09:30-12:00"}'
    )


def test_trailing_count_takes_one_pass(make_ticks):
    """No frame starts at a moving bound, which counts a busy slice anew for each of its points; a time
    just a window before the current one counts, an earlier one does not."""
    import re

    params = dataclasses.replace(P, active_window_sec=10, slice_ms=10_000)
    start = hk_ms(DAY, "10:00:00")
    times = [start + x for x in (0, 1, 2500, 9_999, 10_000, 10_000, 10_001, 12_500, 19_999, 20_002)]
    points = gaps.tick_points(make_ticks([tick("A", DAY, t, i) for i, t in enumerate(times)]), params)
    plan = points._jdf.queryExecution().analyzed().toString()
    begins = re.findall(r"specifiedwindowframe\(RangeFrame, ([^,]+),", plan)
    assert begins and set(begins) == {"unboundedpreceding$()"}
    got = {r.ts_ms: r.active_count for r in points.collect()}
    own = sorted(set(times))
    assert got == {t: sum(t - 10_000 <= x <= t for x in own) for t in own}
