"""Health snapshots, throughput counters, stall detection, digests.

Snapshots of one instance arrive about once a minute. The lookups to an earlier snapshot still run
over day slices with one carried row per slice, so a single instance is not ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock, text
from ..params import HealthParams

SLICE_MS = 86_400_000

# fixed values: age limits of stale symbols, in and outside trading hours
OPEN_STALE_SEC = 10.0
OFF_STALE_SEC = 120.0
OPEN_STALE_BUCKETS = (10.0, 30.0, 60.0)
OFF_STALE_BUCKETS = (120.0, 300.0, 900.0)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Adds ``prev``: a struct of ``columns`` from the row before, NULL at the start of a key.

    ``order`` (milliseconds, distinct per key) is cut into slices; the first row of a slice takes the
    last row of the newest earlier slice.
    """
    keys = list(keys)
    row = F.struct(*columns)
    cut = df.withColumn("_slice", F.floor(F.col(order) / slice_ms))
    inside = Window.partitionBy(*keys, "_slice").orderBy(order)
    ends = cut.groupBy(*keys, "_slice").agg(F.max_by(row, order).alias("_end"))
    carried = ends.select(
        *keys, "_slice", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_c")
    )
    return (
        cut.withColumn("_p", F.lag(row).over(inside))
        .join(carried, [*keys, "_slice"])
        .select(*df.columns, F.coalesce("_p", "_c").alias("prev"))
    )


def run_lengths(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    flag: Column,
    out: str,
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Length of the unbroken run of ``flag`` ending at each row; 0 where the flag is off.

    Inside a slice runs are counted after the last break; a run that begins before the slice adds the
    rows carried from earlier slices, which are themselves summed from one row per slice.
    """
    keys = list(keys)
    cut = df.withColumns(
        {
            "_slice": F.floor(F.col(order) / slice_ms),
            "_off": (~F.coalesce(flag, F.lit(False))).cast("int"),
        }
    )
    upto = Window.partitionBy(*keys, "_slice").orderBy(order)
    island = cut.withColumn("_breaks", F.sum("_off").over(upto))
    inner = Window.partitionBy(*keys, "_slice", "_breaks").orderBy(order)
    counted = island.withColumn("_in_run", F.sum(1 - F.col("_off")).over(inner))
    ends = counted.groupBy(*keys, "_slice").agg(
        F.max("_breaks").alias("_all_breaks"), F.max_by("_in_run", order).alias("_tail")
    )
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    grouped = ends.withColumn(
        "_grp", F.sum((F.col("_all_breaks") > 0).cast("int")).over(by_slice)
    )
    in_group = Window.partitionBy(*keys, "_grp").orderBy("_slice")
    carried = grouped.withColumn("_upto", F.sum("_tail").over(in_group)).select(
        *keys, "_slice", F.lag("_upto", 1, 0).over(by_slice).alias("_carry")
    )
    length = F.col("_in_run") + F.when(F.col("_breaks") == 0, F.col("_carry")).otherwise(0)
    return (
        counted.join(carried, [*keys, "_slice"])
        .withColumn(out, F.when(F.col("_off") == 1, F.lit(0)).otherwise(length).cast("bigint"))
        .select(*df.columns, out)
    )


def _ages() -> Column:
    known = F.filter("symbols", lambda s: s["last_tick_age_sec"].isNotNull())
    return F.transform(known, lambda s: s["last_tick_age_sec"])


def lower_rank_of_array(values: Column, p: float) -> Column:
    """Element at ``int((n - 1) * p)`` of the sorted array; NULL for an empty one."""
    ordered = F.sort_array(values)
    position = F.floor((F.size(ordered) - 1) * float(max(0.0, min(1.0, p)))).cast("int")
    return F.when(F.size(ordered) > 0, F.get(ordered, position))


def symbol_extremes(health: DataFrame) -> DataFrame:
    """Largest age (NULL without any), largest lag, p50 and p95 age of each snapshot's symbols."""
    lags = F.transform("symbols", lambda s: F.greatest(F.lit(0), s["max_seq_lag"]))
    return health.withColumns(
        {
            "max_age_sec": F.array_max(_ages()),
            "max_lag": F.coalesce(F.array_max(lags), F.lit(0)),
            "age_p50": lower_rank_of_array(_ages(), 0.50),
            "age_p95": lower_rank_of_array(_ages(), 0.95),
        }
    )


def stale_counts(health: DataFrame, params: HealthParams) -> DataFrame:
    """Symbols at or above the age limit, and in the three cumulative buckets of the phase."""
    is_open = clock.market_phase("created_at_ms", tz=params.tz) == "open"

    def at_least(limit: Column) -> Column:
        return F.size(F.filter(_ages(), lambda a: a >= limit))

    def pick(a: float, b: float) -> Column:
        return F.when(is_open, F.lit(a)).otherwise(F.lit(b))

    return health.withColumns(
        {
            "stale_symbols": at_least(pick(OPEN_STALE_SEC, OFF_STALE_SEC)),
            **{
                f"stale_bucket_{i + 1}": at_least(pick(a, b))
                for i, (a, b) in enumerate(zip(OPEN_STALE_BUCKETS, OFF_STALE_BUCKETS))
            },
        }
    )


def top_stale(health: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` oldest and the ``n`` furthest lagging symbols of each snapshot, ties by symbol."""
    flat = health.select("instance", "sid", F.inline("symbols"))
    aged = flat.where("last_tick_age_sec IS NOT NULL").select(
        "instance", "sid", F.lit("age").alias("kind"), "symbol",
        F.greatest(F.lit(0.0), "last_tick_age_sec").alias("value"),
    )
    lagged = flat.select(
        "instance", "sid", F.lit("lag").alias("kind"), "symbol",
        F.greatest(F.lit(0), "max_seq_lag").cast("double").alias("value"),
    )
    order = Window.partitionBy("instance", "sid", "kind").orderBy(F.col("value").desc(), "symbol")
    ranked = aged.unionByName(lagged).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= max(1, n))


def quiet_candidate(params: HealthParams) -> Column:
    """No flow, empty queue, and all symbols long without a tick."""
    still = (
        (F.col("persisted_rows_per_min") <= 0)
        & (F.col("push_rows_per_min") <= 0)
        & (F.col("poll_accepted") <= 0)
        & (F.col("queue_size") <= 0)
    )
    return (
        still
        & (F.col("age_p50") >= params.quiet_p50_age_sec)
        & (F.col("age_p95") >= params.quiet_p95_age_sec)
    )


def quiet_runs(health: DataFrame, params: HealthParams) -> DataFrame:
    """``quiet_run``: consecutive quiet snapshots within the open phase, and the phase itself."""
    staged = symbol_extremes(health).withColumn(
        "phase", clock.market_phase("created_at_ms", tz=params.tz)
    )
    flag = (F.col("phase") == "open") & quiet_candidate(params)
    return run_lengths(staged, ["instance"], "created_at_ms", flag, "quiet_run")


def throughput_drop(health: DataFrame) -> DataFrame:
    """``low_persist``: some rows stored, but under three tenths of the minute before."""
    prev = F.col("prev.persisted_rows_per_min")
    now = F.greatest(F.lit(0), F.col("persisted_rows_per_min"))
    limit = F.greatest(F.lit(1), F.floor(F.greatest(F.lit(0), prev) * 0.3))
    drop = (prev > 0) & (now > 0) & (now < limit)
    out = with_previous(health, ["instance"], "created_at_ms", ["persisted_rows_per_min"])
    return out.withColumn("low_persist", F.coalesce(drop, F.lit(False))).drop("prev")


def assess_health(health: DataFrame, params: HealthParams) -> DataFrame:
    """Severity, needed action and market mode of every snapshot."""
    base = throughput_drop(quiet_runs(health, params))
    mode = F.when(
        (F.col("phase") == "open") & (F.col("quiet_run") >= params.quiet_cycles), "holiday-closed"
    ).otherwise(F.col("phase"))
    queue_pct = text.queue_utilisation_pct("queue_size", "queue_maxsize")
    persisted = F.greatest(F.lit(0), "persisted_rows_per_min")
    queue = F.greatest(F.lit(0), "queue_size")
    stopped = (persisted == 0) & ((queue > 0) | (F.col("max_lag") > 0))
    late = F.coalesce(F.abs("drift_sec") >= params.drift_warn_sec, F.lit(False))
    weak = late | (queue_pct >= 60.0) | F.col("low_persist")
    backlog = (queue > 0) & (persisted <= 0)
    finding = (
        F.when(mode == "open", F.when(stopped, "write_stopped").when(weak, "degraded"))
        .when(mode == "pre-open", F.when(queue_pct >= 80.0, "queue_high"))
        .otherwise(F.when(backlog, "backlog"))
    )
    return base.withColumns(
        {
            "market_mode": mode,
            "queue_pct": queue_pct,
            "finding": F.coalesce(finding, F.lit("normal")),
            "severity": F.when(finding.isNotNull(), "WARN").otherwise("OK"),
            "needs_action": finding.isNotNull(),
        }
    )


def threshold_crossings(
    health: DataFrame, queue_pct: float = 20.0, age_sec: float = 60.0, drift_sec: float = 60.0
) -> DataFrame:
    """``changed``: the snapshot differs noticeably from the one before."""
    staged = symbol_extremes(health).withColumn(
        "queue_pct", text.queue_utilisation_pct("queue_size", "queue_maxsize")
    )
    fields = ["queue_pct", "max_age_sec", "persisted_rows_per_min", "drift_sec"]
    out = with_previous(staged, ["instance"], "created_at_ms", fields)

    def crossed(name: str, limit: float, absolute: bool) -> Column:
        shape = F.abs if absolute else (lambda c: c)
        a, b = shape(F.col(f"prev.{name}")), shape(F.col(name))
        both = ((a < limit) & (b >= limit)) | ((a >= limit) & (b < limit))
        only_new = b >= limit
        return F.when(a.isNotNull() & b.isNotNull(), both).otherwise(
            F.coalesce(only_new, F.lit(False))
        )

    moved = (
        (F.abs(F.col("queue_pct") - F.col("prev.queue_pct")) >= queue_pct)
        | crossed("max_age_sec", age_sec, False)
        | (
            (F.col("persisted_rows_per_min") > 0)
            != (F.col("prev.persisted_rows_per_min") > 0)
        )
        | crossed("drift_sec", drift_sec, True)
    )
    changed = F.when(F.col("prev").isNull(), F.lit(False)).otherwise(
        F.coalesce(moved, F.lit(False))
    )
    return out.withColumn("changed", changed).drop("prev")


def counter_delta(
    counters: DataFrame, name: str, threshold: int = 3, order: str = "created_at_ms"
) -> DataFrame:
    """Growth of a running counter per instance, never negative; flagged from ``threshold`` on."""
    out = with_previous(counters, ["instance"], order, [name])
    delta = F.greatest(F.lit(0), F.col(name) - F.coalesce(F.col(f"prev.{name}"), F.lit(0)))
    return out.withColumn("delta", delta).withColumn("alert", F.col("delta") >= threshold).drop(
        "prev"
    )


def sequence_advance(fetches: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """``advanced``: a fetch brought a higher seq than every fetch of its symbol before.

    ``fetches``: symbol, fetched_at_ms, max_seq. Earlier slices enter by their maximum only.
    """
    cut = fetches.withColumn("_slice", F.floor(F.col("fetched_at_ms") / slice_ms))
    inside = (
        Window.partitionBy("symbol", "_slice")
        .orderBy("fetched_at_ms")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = (
        Window.partitionBy("symbol").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        cut.groupBy("symbol", "_slice")
        .agg(F.max("max_seq").alias("_m"))
        .select("symbol", "_slice", F.max("_m").over(earlier).alias("_carry"))
    )
    best = F.greatest(F.col("_best"), F.col("_carry"))
    higher = F.col("max_seq").isNotNull() & (best.isNull() | (F.col("max_seq") > best))
    return (
        cut.withColumn("_best", F.max("max_seq").over(inside))
        .join(carried, ["symbol", "_slice"])
        .withColumn("advanced", higher)
        .select(*fetches.columns, "advanced")
    )


def daily_digest(health: DataFrame, alerts: DataFrame | None = None) -> DataFrame:
    """Per instance and day: stored rows, peak minute, largest lag, table rows at start and end, growth, and the
    alerts sent and recovered."""
    stored = F.greatest(F.lit(0), F.col("persisted_rows_per_min"))
    digest = health.groupBy("instance", "trading_day").agg(
        F.sum(stored).alias("total_rows"),
        F.max(stored).alias("peak_rows_per_min"),
        F.max(F.abs(F.coalesce("drift_sec", F.lit(0.0)))).alias("max_lag_sec"),
        F.min_by("db_rows", "created_at_ms").alias("start_db_rows"),
        F.max("db_rows").alias("db_rows"),
    )
    digest = digest.withColumn(
        "growth_rows", F.greatest(F.lit(0), F.col("db_rows") - F.col("start_db_rows"))
    )
    if alerts is None:
        return digest
    sent = alerts.where("emitted").groupBy("instance", "trading_day").agg(
        F.count_if((F.col("kind") == "alert") & F.col("severity").isin("WARN", "ALERT")).alias(
            "alert_count"
        ),
        F.count_if(F.col("kind") == "resolve").alias("recovered_count"),
    )
    return digest.join(sent, ["instance", "trading_day"], "left").fillna(
        {"alert_count": 0, "recovered_count": 0}
    )


def digest_due(emissions: DataFrame, params: HealthParams) -> DataFrame:
    """The snapshot that brings a day's digest: the first one shown as OK after the close."""
    local = F.col("created_at_ms")
    after_close = (clock.second_of_day(local, params.tz) >= clock.CLOSE_SEC) & (
        clock.weekday(local, params.tz) < 5
    )
    shown = F.col("emitted") & (F.col("severity") == "OK")
    return (
        emissions.where(shown & (F.col("market_mode") == "after-hours") & after_close)
        .groupBy("instance", "trading_day")
        .agg(F.min("created_at_ms").alias("due_at_ms"))
    )


def alert_counts(alerts: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent codes per day, leaving out OK; ties by code."""
    counted = (
        alerts.where(~F.coalesce(F.col("severity"), F.lit("")).contains("OK"))
        .groupBy("trading_day", F.upper("code").alias("code"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("trading_day").orderBy(F.col("n").desc(), "code")
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def write_stalls(metrics: DataFrame, params: HealthParams, slice_ms: int = SLICE_MS) -> DataFrame:
    """Minutes in which input arrives or waits, but nothing is committed.

    ``metrics``: instance, minute_ms, started_at_ms, queue_size, persisted_rows, queue_in, queue_out,
    push_rows, poll_enqueued, poll_fetched, poll_seq_advanced, upstream_at_ms, commit_at_ms,
    worker_alive. The last commit and the last upstream activity are running maxima, carried over day
    slices by one row each; before any commit the age counts from the start.
    """
    marks = ["commit_at_ms", "upstream_at_ms"]
    cut = metrics.withColumn("_slice", F.floor(F.col("minute_ms") / slice_ms))
    inside = (
        Window.partitionBy("instance", "_slice")
        .orderBy("minute_ms")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy("instance").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        cut.groupBy("instance", "_slice")
        .agg(*[F.max(m).alias(f"_m_{m}") for m in marks])
        .select(
            "instance", "_slice", *[F.max(f"_m_{m}").over(earlier).alias(f"_c_{m}") for m in marks]
        )
    )
    rows = cut.withColumns({f"_r_{m}": F.max(m).over(inside) for m in marks}).join(
        carried, ["instance", "_slice"]
    )
    last = lambda m: F.greatest(F.col(f"_r_{m}"), F.col(f"_c_{m}"))
    now = F.col("minute_ms")
    commit_age = (now - F.coalesce(last("commit_at_ms"), F.col("started_at_ms"))) / 1000.0
    enqueued = F.greatest(F.col("queue_in"), F.col("push_rows") + F.col("poll_enqueued"))
    poll_active = (F.col("poll_fetched") > 0) & (F.col("poll_seq_advanced") > 0)
    recent = F.coalesce(
        now - last("upstream_at_ms") <= params.upstream_window_sec * 1000, F.lit(False)
    )
    active = recent & ((enqueued > 0) | poll_active | (F.col("queue_out") > 0))
    backlog = F.col("queue_size") >= max(1, params.queue_threshold_rows)
    dead = ~F.col("worker_alive")
    quiet = (F.col("persisted_rows") <= 0) & (F.col("commit_age_sec") >= params.stall_sec)
    stalled = (backlog | (enqueued > 0)) & (active | backlog) & (quiet | dead)
    reason = F.when(stalled & dead, "worker_dead").when(stalled, "no_commit")
    return rows.withColumn("commit_age_sec", commit_age).select(
        *metrics.columns, "commit_age_sec", stalled.alias("stalled"), reason.alias("reason")
    )


def drop_muted(health: DataFrame, mutes: DataFrame) -> DataFrame:
    """Health rows left after mute intervals (instance, from_ms, until_ms): OK and WARN rows inside
    an interval go, ALERT rows stay.

    Intervals are spread over the days they touch, so the anti join is an equi join per instance and
    day with the exact bounds as condition; only the row's own day is probed.
    """
    day = lambda c: F.floor(c / SLICE_MS).cast("bigint")
    spans = mutes.select(
        F.col("instance").alias("_who"),
        F.col("from_ms").alias("_from"),
        F.col("until_ms").alias("_until"),
        F.explode(F.sequence(day(F.col("from_ms")), day(F.col("until_ms")))).alias("_span_day"),
    )
    rows = health.withColumn("_day", day(F.col("created_at_ms")))
    hit = (
        (F.col("instance") == F.col("_who"))
        & (F.col("_day") == F.col("_span_day"))
        & (F.col("created_at_ms") >= F.col("_from"))
        & (F.col("created_at_ms") < F.col("_until"))
        & F.col("severity").isin("OK", "WARN")
    )
    return rows.join(spans, hit, "left_anti").drop("_day")
