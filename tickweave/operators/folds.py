"""Ordered decisions that depend on the last decision: alert dedupe, health emission, admission.

The state machines are small and hold a few values per key. In batch, Spark partitions by key and
sorts by time; the partition is then streamed through ``mapInPandas`` with one key's state at a time,
so memory does not grow with the group. In a stream the same machines run on keyed state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import HealthParams

RANK = {"OK": 0, "WARN": 1, "ALERT": 2}


def _rank(severity: object) -> int:
    return RANK.get(str(severity).strip().upper(), 0)


def alert_cooldown_sec(rank: int, params: HealthParams) -> int:
    if rank == 2:
        return params.alert_cadence_sec
    if rank == 1:
        return params.warn_cadence_sec
    return max(30, params.alert_cooldown_sec)


def escalation_steps(rank: int, params: HealthParams) -> list[int]:
    """Configured steps at or above the cooldown, zero, and the cooldown itself for WARN and ALERT."""
    cooldown = alert_cooldown_sec(rank, params)
    steps = {0} | {s for s in (max(0, int(v)) for v in params.escalation_steps) if s >= cooldown}
    return sorted(steps | {cooldown} if rank else steps)


class AlertFold:
    """Decides for each alert of one fingerprint whether to send it, and why."""

    fields = ("kind", "severity", "eid", "sid")
    result = "emitted boolean, reason string, incident_eid string, incident_sid string"

    def __init__(self, params: HealthParams):
        self.params = params

    def start(self) -> dict:
        return {}

    def step(self, state: dict, at: int, row: tuple) -> tuple:
        kind, severity, eid, sid = row
        if kind == "resolve":
            out = (True, "state_recovered", eid or state.get("eid"), sid or state.get("sid"))
            state.clear()
            return out
        reason = self._reason(state, at, _rank(severity))
        if reason == "cooldown_active":
            return (False, reason, state["eid"], state["sid"])
        state["sent"] = at
        if eid:
            state["eid"] = eid
        if sid:
            state["sid"] = sid
        return (True, reason, state["eid"], state["sid"])

    # fixed values: the reason words here and in step
    def _reason(self, state: dict, at: int, rank: int) -> str:
        steps = escalation_steps(rank, self.params)
        if not state:
            positive = [i for i, s in enumerate(steps) if s > 0]
            state.update(
                first=at, rank=rank, step=positive[0] if positive else len(steps), eid=None, sid=None
            )
            return "new"
        if rank > state["rank"]:
            state["rank"] = rank
            return "severity_upgraded"
        cooled = at - state["sent"] >= max(1, alert_cooldown_sec(rank, self.params)) * 1000
        if not cooled:
            return "cooldown_active"
        due = state["step"] < len(steps) and at - state["first"] >= steps[state["step"]] * 1000
        if due:
            state["step"] += 1
            return f"escalation_step_{steps[state['step'] - 1]}s"
        return "cooldown_elapsed"


class HealthEmissionFold:
    """Decides for each assessed snapshot of one instance whether it is shown.

    Once per phase and day while OK, at a change of phase or severity, else by cadence. A muted
    snapshot moves the state but counts as not sent.
    """

    fields = ("trading_day", "market_mode", "severity", "muted")
    result = "emitted boolean, reason string"

    def __init__(self, params: HealthParams):
        self.params = params

    def start(self) -> dict:
        return {"once": []}

    def _once(self, mode: str) -> bool:
        p = self.params
        return (
            mode == "pre-open"
            or (mode == "lunch-break" and p.lunch_once)
            or (mode == "after-hours" and p.after_close_once)
            or (mode == "holiday-closed" and p.holiday_mode == "daily")
        )

    def _cadence_sec(self, mode: str, severity: str) -> int:
        p = self.params
        if p.fixed_interval_sec is not None:
            return p.fixed_interval_sec
        if severity == "ALERT":
            return p.alert_cadence_sec
        if severity == "WARN":
            return p.warn_cadence_sec
        if mode == "open":
            return p.trading_interval_sec
        return p.preopen_interval_sec if mode == "pre-open" else p.offhours_interval_sec

    # fixed values: reasons of a withheld phase
    _withheld = {
        "pre-open": "preopen_once",
        "lunch-break": "lunch_once",
        "after-hours": "after_hours_once",
        "holiday-closed": "holiday_daily_once",
    }

    def step(self, state: dict, at: int, row: tuple) -> tuple:
        day, mode, severity, muted = row
        emit, reason = self._decide(state, at, day, mode, severity)
        state["severity"], state["mode"] = severity, mode
        if emit and muted and severity in ("OK", "WARN"):
            return (False, "muted")
        if emit:
            state["sent"] = at
        return (emit, reason)

    # fixed values: the reason words
    def _decide(self, state: dict, at: int, day: str, mode: str, severity: str) -> tuple:
        p = self.params
        phase = f"{day}:{mode}"
        if p.fixed_interval_sec is None and severity == "OK":
            if mode == "holiday-closed" and p.holiday_mode == "disabled":
                return (False, "holiday_disabled")
            if self._once(mode) and phase in state["once"]:
                return (False, self._withheld[mode])
        if "severity" not in state:
            reason = "bootstrap"
        elif state["mode"] != mode:
            reason = "market_mode_changed"
        elif state["severity"] != severity:
            reason = "state_changed"
        elif "sent" not in state or at - state["sent"] >= self._cadence_sec(mode, severity) * 1000:
            reason = f"{severity.lower()}_cadence"
        else:
            return (False, f"{severity.lower()}_cooldown")
        if severity == "OK" and self._once(mode):
            # only the current day can be asked for again
            state["once"] = [x for x in state["once"] if x.startswith(f"{day}:")] + [phase]
        return (True, reason)


class AdmissionFold:
    """At most ``limit`` admitted per sliding window; the rest is rejected with the delay to wait."""

    fields = ()
    result = "admitted boolean, delay_ms bigint"

    def __init__(self, limit: int, window_sec: float = 60.0):
        self.limit = max(1, int(limit))
        self.window_ms = int(max(1.0, float(window_sec)) * 1000)

    def start(self) -> dict:
        return {"hits": []}

    def step(self, state: dict, at: int, row: tuple) -> tuple:
        hits = [t for t in state["hits"] if at - t < self.window_ms]
        admitted = len(hits) < self.limit
        if admitted:
            hits.append(at)
        state["hits"] = hits
        return (admitted, 0 if admitted else max(0, self.window_ms - (at - hits[0])))

    def until(self, state: dict) -> int | None:
        return state["hits"][-1] + self.window_ms if state["hits"] else None


class RepeatFold:
    """Keeps a row unless one of its key was kept within ``horizon_ms`` of its time, before or after.

    Kept times of a key lie more than a horizon apart, so few are held; ``until`` lets a stream forget them.
    """

    fields = ()
    result = "kept boolean"

    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def start(self) -> dict:
        return {"kept": []}

    def step(self, state: dict, at: int, row: tuple) -> tuple:
        if any(abs(at - kept) <= self.horizon_ms for kept in state["kept"]):
            return (False,)
        state["kept"].append(at)
        return (True,)

    def until(self, state: dict) -> int:
        return max(state["kept"]) + self.horizon_ms + 1


class RecentKeysFold:
    """Drops polled rows whose key is among the newest ``limit`` that were remembered, first in first out.

    Rows of other origins are always kept. A kept row's key is remembered unless it is already; that moves
    it no further back.
    """

    fields = ("push_type", "ts_ms", "price", "volume", "turnover")
    result = "kept boolean"

    def __init__(self, limit: int = 500):
        self.limit = max(1, int(limit))

    def start(self) -> dict:
        return {"keys": {}}  # a dict keeps the order of arrival, and is a set as well

    def step(self, state: dict, at: int, row: tuple) -> tuple:
        keys = state["keys"]
        origin, *parts = row
        key = "|".join("" if part is None else repr(float(part)) for part in parts)
        if key in keys:
            return (origin != "poll",)
        keys[key] = 1
        if len(keys) > self.limit:
            del keys[next(iter(keys))]
        return (True,)


class CooldownFold:
    """Drops events of a key until the cooldown of the last kept one has passed."""

    fields = ("cooldown_sec",)
    result = "kept boolean, suppressed_count bigint"

    def start(self) -> dict:
        return {}

    def step(self, state: dict, at: int, row: tuple) -> tuple:
        if "last" not in state or at - state["last"] >= int(row[0]) * 1000:
            out = (True, state.get("dropped", 0))
            state.update(last=at, dropped=0)
            return out
        state["dropped"] = state.get("dropped", 0) + 1
        return (False, 0)


def _none(value):
    return None if value is None or value != value else value


#: The column types that folds give.
_ARROW = {"boolean": pa.bool_(), "string": pa.string(), "bigint": pa.int64()}


def _values(column: pa.Array) -> list:
    """Python values; a missing number is None."""
    values = column.to_pylist()
    return [_none(v) for v in values] if pa.types.is_floating(column.type) else values


def fold_partition(
    fold, keys: Sequence[str], time: str
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function over rows sorted by key and time; the state outlives a batch. The rows
    themselves pass as they are, and only what the fold looks at becomes Python values."""
    results = [part.split() for part in fold.result.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            read = [list(zip(*[_values(batch.column(c)) for c in names])) for names in (keys, fold.fields) if names]
            args = read[1] if fold.fields else [()] * batch.num_rows
            outs = []
            for key, at, row in zip(read[0], batch.column(time).to_pylist(), args):
                if key != current:
                    current, state = key, fold.start()
                outs.append(fold.step(state, at, row))
            found = [pa.array(values, _ARROW[kind]) for values, (_, kind) in zip(zip(*outs), results)]
            names = [*batch.schema.names, *(name for name, _ in results)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=names)

    return run


def apply_fold(
    df: DataFrame, fold, keys: Sequence[str], time: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Run a fold over each key's rows in time order, adding its result columns."""
    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    ordered = df.repartition(*keys).sortWithinPartitions(*keys, time, *ties)
    return ordered.mapInArrow(fold_partition(fold, list(keys), time), f"{base}, {fold.result}")


ALERT_KEYS = ["instance", "fingerprint"]


def named_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts with the fingerprint their incident goes by; without instances they are of one."""
    if "instance" not in alerts.columns:
        alerts = alerts.withColumn("instance", F.lit(""))
    return alerts.withColumns(
        {
            "instance": F.coalesce("instance", F.lit("")),
            "fingerprint": F.coalesce(
                F.nullif(F.trim("fingerprint"), F.lit("")),
                F.nullif(F.col("key"), F.lit("")),
                F.nullif(F.col("code"), F.lit("")),
                F.lit("unknown"),
            ),
        }
    )


def alert_decisions(alerts: DataFrame, params: HealthParams) -> DataFrame:
    """Each alert or resolve row with its decision; incidents of an instance run on over days.

    A resolve empties the state, so it also ends a group: keys are cut behind resolves, and the parts
    are decided in parallel.
    """
    earlier = Window.partitionBy(*ALERT_KEYS).orderBy("created_at_ms", "ord").rowsBetween(
        Window.unboundedPreceding, -1
    )
    resolves = F.coalesce(F.sum(F.when(F.col("kind") == "resolve", 1)).over(earlier), F.lit(0))
    cut = named_alerts(alerts).withColumn("_part", resolves)
    decided = apply_fold(cut, AlertFold(params), [*ALERT_KEYS, "_part"], "created_at_ms", ["ord"])
    return decided.drop("_part")


def health_emissions(assessed: DataFrame, params: HealthParams) -> DataFrame:
    """Assessed snapshots with ``emitted`` and ``reason``; needs a ``muted`` flag or takes none."""
    rows = assessed if "muted" in assessed.columns else assessed.withColumn("muted", F.lit(False))
    return apply_fold(rows, HealthEmissionFold(params), ["instance"], "created_at_ms", ["sid"])


def admissions(
    requests: DataFrame,
    keys: Sequence[str],
    time: str,
    limit: int,
    window_sec: float = 60.0,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Requests with ``admitted`` and the delay a rejected one would have to wait.

    A pause of a whole window empties the state, so it also ends a group: keys are cut at such
    pauses first, and the parts are decided in parallel.
    """
    window_ms = int(max(1.0, float(window_sec)) * 1000)
    cut = split_at_pauses(requests, keys, time, window_ms)
    fold = AdmissionFold(limit, window_sec)
    return apply_fold(cut, fold, [*keys, "_part"], time, ties).drop("_part")


def split_at_pauses(
    df: DataFrame, keys: Sequence[str], time: str, pause_ms: int
) -> DataFrame:
    """Adds ``_part``: the start time of the busy stretch a row belongs to.

    Occupied time slots as long as the pause are found by a distinct; a stretch begins after an empty
    slot. Two rows with a whole empty slot between them are always more than a pause apart.
    """
    keys = list(keys)
    slot = F.floor(F.col(time) / pause_ms)
    slots = df.select(*keys, slot.alias("_slot")).distinct()
    order = Window.partitionBy(*keys).orderBy("_slot")
    fresh = F.coalesce(F.col("_slot") - F.lag("_slot").over(order) > 1, F.lit(True))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = (
        slots.withColumn("_new", F.when(fresh, F.col("_slot")))
        .withColumn("_part", F.last("_new", ignorenulls=True).over(upto))
        .select(*keys, "_slot", "_part")
    )
    return df.withColumn("_slot", slot).join(parts, [*keys, "_slot"]).drop("_slot")
