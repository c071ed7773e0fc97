"""Microstructure events from gated minute features and day profiles.

All bucket-level event types are decided in one pass: each feature row yields an array of its events,
which is then exploded. Levels travel as arrays in the row, so crossing a low-volume node is an array
filter and needs no range join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import MicroParams
from .features import with_gates, with_levels

EVENT_COLUMNS = (
    "ts_ms", "symbol", "event_type", "severity", "score", "dedup_key", "cooldown_sec",
    "payload_json", "created_at_ms", "trading_day",
)
ONCE_A_DAY_SEC = 86_400


def _key(*parts: Column | str) -> Column:
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat_ws("|", F.col("symbol"), F.col("trading_day"), *cols)


def _event(
    kind: Column | str,
    severity: str,
    score: Column,
    key: Column,
    cooldown: int,
    payload: dict[str, Column],
) -> Column:
    return F.struct(
        (F.lit(kind) if isinstance(kind, str) else kind).alias("event_type"),
        F.lit(severity).alias("severity"),
        F.round(F.least(F.lit(100.0), F.greatest(F.lit(0.0), score.cast("double"))), 3).alias(
            "score"
        ),
        key.alias("dedup_key"),
        F.lit(cooldown).alias("cooldown_sec"),
        F.to_json(F.struct(*[v.alias(k) for k, v in payload.items()])).alias("payload_json"),
    )


def _up_down(positive: Column, up: str, down: str) -> Column:
    return F.when(positive, up).otherwise(down)


def with_context(gated: DataFrame, params: MicroParams) -> DataFrame:
    """Neighbour values and flags the event rules refer to, within symbol and day."""
    k = params.accept_buckets
    order = Window.partitionBy("symbol", "trading_day").orderBy("ts_min_ms")
    last_k = order.rowsBetween(-(k - 1), 0)
    stay = (F.count(F.lit(1)).over(last_k) == k) & (F.min("in_value_area").over(last_k) == 1)
    compressed = (F.col("recent_range") <= F.col("range_compress")) & (
        F.col("ticks") <= F.col("ticks_compress")
    )
    comp_bucket = (F.floor(F.col("ts_min_ms") / params.compress_ms) * params.compress_ms).cast(
        "bigint"
    )
    before = order.orderBy("ts_min_ms").rangeBetween(-params.release_ms, -1)
    ctx = gated.withColumns(
        {
            "prev_close": F.lag("close").over(order),
            "prev_high": F.lag("high").over(order),
            "prev_low": F.lag("low").over(order),
            "stayed": F.coalesce(stay, F.lit(False)),
            "came_above": F.lag("above_vah", k).over(order),
            "came_below": F.lag("below_val", k).over(order),
            "compressed": F.coalesce(compressed, F.lit(False)),
            "comp_bucket": comp_bucket,
        }
    )
    ctx = ctx.withColumn(
        "last_comp",
        F.max_by(
            F.when(F.col("compressed"), F.col("comp_bucket")),
            F.when(F.col("compressed"), F.col("ts_min_ms")),
        ).over(before),
    )
    crossed = F.filter(
        F.col("lvn"),
        lambda n: (
            ((F.col("prev_close") < n["price"]) & (n["price"] <= F.col("close")))
            | ((F.col("prev_close") > n["price"]) & (n["price"] >= F.col("close")))
        ),
    )
    direction = F.signum("price_change")
    return ctx.withColumns(
        {
            "crossed_lvn": F.when(
                F.col("impact") > F.col("impact_median") * params.lvn_impact_factor, crossed
            ),
            "any_crossed": crossed,
            "initiation": F.coalesce(
                (F.col("abs_return") >= F.col("ret_init"))
                & (F.col("impact") >= F.col("impact_init"))
                & (direction != 0)
                & (direction == F.signum("imbalance")),
                F.lit(False),
            ),
        }
    )


def bucket_events(ctx: DataFrame, params: MicroParams, created_at_ms: int) -> DataFrame:
    """Events of single buckets: acceptance, rejection, node breakout, absorption, initiation,
    vacuum, compression, release."""
    c = F.col
    when = F.when
    upward = c("price_change") > 0
    outside = (c("above_vah") == 1) | (c("below_val") == 1)
    crossed_any = F.coalesce(F.size("any_crossed") > 0, F.lit(False))

    accept = when(
        c("stayed") & ((c("came_above") == 1) | (c("came_below") == 1)),
        _event(
            "VALUE_ACCEPTANCE", "INFO", F.lit(50.0), _key("VA_ACCEPT"), 1800,
            {
                "from": when(c("came_above") == 1, "above_vah").otherwise("below_val"),
                "poc": c("poc"), "vah": c("vah"), "val": c("val"),
                "minutes_in_va": F.lit(params.accept_buckets),
            },
        ),
    )

    at_vah = (c("prev_high") >= c("vah")) & (c("close") > c("vah"))
    at_val = (c("prev_low") <= c("val")) & (c("close") < c("val"))
    edge = when(at_vah, "VAH").when(at_val, "VAL")
    reject = when(
        (at_vah | at_val) & (c("abs_return") > c("ret_reject")),
        _event(
            "VALUE_REJECTION", "WARN",
            50 + 25 * F.least(F.lit(2.0), c("abs_return") / (c("ret_reject") + params.eps)),
            _key("VA_REJECT", edge), 900,
            {
                "edge": edge, "level": when(at_vah, c("vah")).otherwise(c("val")),
                "touch_price": when(at_vah, c("prev_high")).otherwise(c("prev_low")),
                "close": c("close"), "abs_return": c("abs_return"),
            },
        ),
    )

    nodes = F.transform(
        c("crossed_lvn"),
        lambda n: _event(
            _up_down(c("close") >= c("prev_close"), "LVN_BREAKOUT_UP", "LVN_BREAKOUT_DOWN"),
            "ALERT",
            60 + 10 * F.least(F.lit(4.0), c("impact") / (c("impact_median") + params.eps)),
            _key(
                "LVN",
                F.concat(F.lit("price="), n["price"].cast("decimal(18,4)").cast("string")),
                F.concat(F.lit("dir="), _up_down(c("close") >= c("prev_close"), "up", "down")),
            ),
            1200,
            {
                "lvn": n["price"],
                "impact": c("impact"),
                "impact_vs_med": c("impact") / (c("impact_median") + params.eps),
                "window_ms": F.lit(params.short_ms),
            },
        ),
    )

    def dist(level: str) -> Column:
        return F.abs(c("close") - c(level))

    nearest = F.least(dist("poc"), dist("vah"), dist("val"))
    nearest_name = (
        when(dist("poc") == nearest, "POC").when(dist("vah") == nearest, "VAH").otherwise("VAL")
    )
    near = F.coalesce(
        nearest <= params.absorb_near_ticks * params.tick_size, F.lit(False)
    ).cast("int")
    calm = when(c("abs_return") == 0, F.lit(0.0)).otherwise(
        F.least(F.lit(1.0), c("abs_return") / c("ret_absorb"))
    )
    busy = F.least(F.lit(1.0), c("volume") / (c("volume_absorb") + params.eps) / 2)
    absorb = when(
        (F.abs("imbalance") >= params.absorb_imbalance)
        & (c("abs_return") <= c("ret_absorb"))
        & (c("volume") >= c("volume_absorb")),
        _event(
            _up_down(c("imbalance") > 0, "ABSORPTION_BUY", "ABSORPTION_SELL"), "WARN",
            40 * busy + 40 * (1 - calm) + 20 * near,
            _key(
                "ABSORB",
                F.concat(F.lit("side="), _up_down(c("imbalance") > 0, "buy", "sell")),
                F.concat(F.lit("level="), F.coalesce(nearest_name, F.lit("none"))),
            ),
            900,
            {
                "imbalance": c("imbalance"), "volume": c("volume"),
                "volume_gate": c("volume_absorb"), "ret_gate": c("ret_absorb"),
                "nearest_level": nearest_name, "dist": nearest,
            },
        ),
    )

    direction = _up_down(upward, "up", "down")
    initiate = when(
        c("initiation"),
        _event(
            _up_down(upward, "INITIATION_UP", "INITIATION_DOWN"), "ALERT",
            60 + 20 * crossed_any.cast("int") + 20 * F.coalesce(outside, F.lit(False)).cast("int"),
            _key(
                "INIT",
                F.concat(F.lit("dir="), direction),
                F.concat(F.lit("band="), when(c("in_value_area") == 1, "va").otherwise("outer")),
            ),
            600,
            {
                "abs_return": c("abs_return"), "ret_gate": c("ret_init"), "impact": c("impact"),
                "impact_gate": c("impact_init"), "crossed_lvn": crossed_any,
                "in_value_area": c("in_value_area"),
            },
        ),
    )

    multi_tick = F.abs("price_change") >= params.jump_ticks * params.tick_size - params.eps
    vacuum = when(
        (c("impact") >= c("impact_vacuum"))
        & ((c("jump_count") >= params.vacuum_jumps) | multi_tick)
        & (c("price_change") != 0),
        _event(
            _up_down(upward, "LIQUIDITY_VACUUM_UP", "LIQUIDITY_VACUUM_DOWN"), "ALERT",
            60 + 20 * F.least(F.lit(2.0), c("impact") / (c("impact_vacuum") + params.eps)),
            _key("VACUUM", F.concat(F.lit("dir="), direction), "impact_band=p90+"), 900,
            {
                "impact": c("impact"), "impact_gate": c("impact_vacuum"), "volume": c("volume"),
                "jump_count": c("jump_count"),
            },
        ),
    )

    compress = when(
        c("compressed"),
        _event(
            "RANGE_COMPRESSION", "INFO", F.lit(40.0), _key("COMP", F.concat(F.lit("15m_bucket="), c("comp_bucket"))), 1800,
            {
                "range": c("recent_range"), "range_gate": c("range_compress"),
                "ticks": c("ticks"), "ticks_gate": c("ticks_compress"),
            },
        ),
    )

    breakout = F.coalesce(F.size("crossed_lvn") > 0, F.lit(False))
    released = (c("initiation") | breakout) & c("last_comp").isNotNull()
    release_up = when(c("initiation"), upward).otherwise(c("close") >= c("prev_close"))
    release = when(
        released,
        _event(
            _up_down(release_up, "BREAKOUT_RELEASE_UP", "BREAKOUT_RELEASE_DOWN"), "ALERT",
            F.lit(80.0) + 10 * c("initiation").cast("int") + 10 * breakout.cast("int"),
            _key(
                "RELEASE",
                F.concat(F.lit("dir="), _up_down(release_up, "up", "down")),
                F.concat(F.lit("from_comp="), c("last_comp").cast("string")),
            ),
            1200,
            {
                "comp_bucket": c("last_comp"), "impact": c("impact"),
                "abs_return": c("abs_return"),
            },
        ),
    )

    single = F.array_compact(
        F.array(accept, reject, absorb, initiate, vacuum, compress, release)
    )
    every = F.concat(single, F.coalesce(nodes, F.slice(single, 1, 0)))
    return ctx.select(
        F.col("ts_min_ms").alias("ts_ms"), "symbol", "trading_day", F.explode(every).alias("_e")
    ).select(
        "ts_ms", "symbol", "trading_day", "_e.*",
        F.lit(created_at_ms).cast("bigint").alias("created_at_ms"),
    ).select(*EVENT_COLUMNS)


def open_imbalance(days: DataFrame, params: MicroParams, created_at_ms: int) -> DataFrame:
    """Opening auction concentrated on few prices and confirmed by the first minutes after it."""
    share = F.when(F.col("open_vol") > 0, F.col("open_top3") / F.col("open_vol"))
    opening = F.signum(F.col("open_last.price") - F.col("open_first.price"))
    after = F.signum(F.col("confirm_last.price") - F.col("confirm_first.price"))
    hits = days.withColumns({"_share": share, "_opening": opening, "_after": after}).where(
        (F.col("_share") >= params.open_top3_share)
        & (F.col("_opening") != 0)
        & (F.col("_opening") == F.col("_after"))
    )
    event = _event(
        "OPEN_IMBALANCE", "WARN", F.col("_share") * 100, _key("OPEN_IMB"), ONCE_A_DAY_SEC,
        {
            "range": F.col("open_auc_range"), "top3_share": F.col("_share"),
            "confirmed": F.lit(True),
            "direction": _up_down(F.col("_opening") > 0, "up", "down"),
        },
    )
    return _day_events(hits, F.col("confirm_last.ts_ms"), event, created_at_ms)


def close_dominance(levels: DataFrame, params: MicroParams, created_at_ms: int) -> DataFrame:
    """Closing auction with a large share of the day's volume and a close far from the POC."""
    span = F.col("high") - F.col("low")
    facts = levels.withColumns(
        {
            "_share": F.col("close_vol") / F.col("total_volume"),
            "_away": F.when(span > 0, F.abs(F.col("close") - F.col("poc")) / span),
        }
    ).where(
        (F.col("_share") >= params.close_share) & (F.col("_away") >= params.close_distance)
    )
    event = _event(
        "CLOSE_AUCTION_DOMINANCE", "ALERT",
        50 + 50 * F.least(F.lit(1.0), F.col("_share") + F.col("_away")),
        _key("CLOSE_DOM"), ONCE_A_DAY_SEC,
        {
            "share": F.col("_share"), "distance": F.col("_away"), "poc": F.col("poc"),
            "vah": F.col("vah"), "val": F.col("val"),
            "close_strength": F.col("close_strength_score"),
        },
    )
    midnight = F.unix_millis(
        F.to_utc_timestamp(F.try_to_timestamp("trading_day", F.lit("yyyyMMdd")), params.tz)
    )
    return _day_events(
        facts, midnight + params.close_auction[1] * 1000, event, created_at_ms
    )


def _day_events(days: DataFrame, ts: Column, event: Column, created_at_ms: int) -> DataFrame:
    return (
        days.select(ts.cast("bigint").alias("ts_ms"), "symbol", "trading_day", event.alias("_e"))
        .select(
            "ts_ms", "symbol", "trading_day", "_e.*",
            F.lit(created_at_ms).cast("bigint").alias("created_at_ms"),
        )
        .select(*EVENT_COLUMNS)
    )


def all_events(
    features: DataFrame, days: DataFrame, params: MicroParams, created_at_ms: int
) -> DataFrame:
    """All ten event types from minute features and day levels."""
    gated = with_gates(with_levels(features, days, params), params)
    return gated_events(gated, days, params, created_at_ms)


def gated_events(
    gated: DataFrame, days: DataFrame, params: MicroParams, created_at_ms: int
) -> DataFrame:
    """As ``all_events``, from features that have their levels and gates already."""
    ctx = with_context(gated, params)
    return (
        bucket_events(ctx, params, created_at_ms)
        .unionByName(open_imbalance(days, params, created_at_ms))
        .unionByName(close_dominance(days, params, created_at_ms))
    )


def distinct_events(events: DataFrame) -> DataFrame:
    """One row per (time, symbol, type, dedup key)."""
    return events.dropDuplicates(["ts_ms", "symbol", "event_type", "dedup_key"])


def apply_cooldown(events: DataFrame) -> DataFrame:
    """Drop events of a key until its cooldown, counted from the last kept one, has passed.

    Keeps ``suppressed_count``: how many were dropped since the previous kept event of the key. The
    fold runs over the time-ordered events of one key as an array expression. A key holds symbol and
    day and has at most one event per bucket, so its array is bounded by the buckets of a day.
    """
    columns = [c for c in EVENT_COLUMNS if c in events.columns]
    other = [c for c in columns if c not in ("symbol", "dedup_key", "ts_ms")]
    item = F.struct("ts_ms", *other)
    grouped = events.groupBy("symbol", "dedup_key").agg(
        F.sort_array(F.collect_list(item)).alias("_all")
    )
    kept_type = "array<struct<i:int,n:int>>"
    start = F.struct(
        F.lit(None).cast("bigint").alias("last"),
        F.lit(0).alias("i"),
        F.lit(0).alias("dropped"),
        F.array().cast(kept_type).alias("kept"),
    )

    def step(acc: Column, e: Column) -> Column:
        emit = acc["last"].isNull() | (
            e["ts_ms"] - acc["last"] >= e["cooldown_sec"].cast("bigint") * 1000
        )
        return F.struct(
            F.when(emit, e["ts_ms"]).otherwise(acc["last"]).alias("last"),
            (acc["i"] + 1).alias("i"),
            F.when(emit, 0).otherwise(acc["dropped"] + 1).alias("dropped"),
            F.when(
                emit,
                F.array_append(
                    acc["kept"],
                    F.struct((acc["i"] + 1).alias("i"), acc["dropped"].alias("n")),
                ),
            )
            .otherwise(acc["kept"])
            .alias("kept"),
        )

    folded = grouped.select(
        "symbol", "dedup_key", "_all", F.explode(F.aggregate("_all", start, step)["kept"]).alias("k")
    )
    picked = folded.withColumn("_e", F.element_at("_all", F.col("k.i")))
    return picked.select(
        *[
            F.col(c) if c in ("symbol", "dedup_key") else F.col(f"_e.{c}").alias(c)
            for c in columns
        ],
        F.col("k.n").alias("suppressed_count"),
    )


def pushed(events: DataFrame) -> DataFrame:
    """Events worth a notice: alerts always, warnings by score, information never."""
    kind = F.col("event_type")
    warn = (
        (kind.startswith("ABSORPTION") & (F.col("score") >= 75))
        | ((kind == "VALUE_REJECTION") & (F.col("score") >= 70))
        | (kind == "OPEN_IMBALANCE")
    )
    return events.where(
        (F.col("severity") == "ALERT") | ((F.col("severity") == "WARN") & warn)
    )


def latest_events(events: DataFrame, symbol: str, n: int = 50) -> DataFrame:
    return (
        events.where(F.col("symbol") == symbol)
        .orderBy(F.col("ts_ms").desc(), "event_type", "dedup_key")
        .limit(n)
    )


def event_counts(events: DataFrame, now_ms: int, hours: int = 24) -> DataFrame:
    return (
        events.where(F.col("ts_ms") >= now_ms - hours * 3_600_000)
        .groupBy("event_type", "severity")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def level_crossings(features: DataFrame, levels: DataFrame) -> DataFrame:
    """Low-volume nodes between the previous and the current close, as an equi join per symbol and
    day with a range condition; a day has few nodes and a bounded number of buckets."""
    order = Window.partitionBy("symbol", "trading_day").orderBy("ts_min_ms")
    moves = features.withColumn("prev_close", F.lag("close").over(order)).where(
        "prev_close <> close"
    )
    nodes = levels.select("symbol", "trading_day", F.explode("lvn").alias("_n")).select(
        "symbol", "trading_day", F.col("_n.price").alias("lvn_price")
    )
    up = (F.col("prev_close") < F.col("lvn_price")) & (F.col("lvn_price") <= F.col("close"))
    down = (F.col("prev_close") > F.col("lvn_price")) & (F.col("lvn_price") >= F.col("close"))
    return (
        moves.join(nodes, ["symbol", "trading_day"])
        .where(up | down)
        .select(
            "symbol", "trading_day", "ts_min_ms", "prev_close", "close", "lvn_price",
            F.when(up, "up").otherwise("down").alias("direction"),
        )
    )


def latest_before(
    later: DataFrame, earlier: DataFrame, within_ms: int, time: str = "ts_ms"
) -> DataFrame:
    """Each later row with the newest earlier row of its symbol and day within ``within_ms`` before
    it. Both sides are stacked and read through one window, so no pairs are produced."""
    left = later.select(
        "symbol", "trading_day", F.col(time).alias("_t"), F.lit(1).alias("_side"),
        F.struct(*later.columns).alias("_row"), F.lit(None).cast("bigint").alias("_at"),
    )
    right = earlier.select(
        "symbol", "trading_day", F.col(time).alias("_t"), F.lit(0).alias("_side"),
        F.lit(None).alias("_row"), F.col(time).alias("_at"),
    )
    before = (
        Window.partitionBy("symbol", "trading_day").orderBy("_t").rangeBetween(-within_ms, -1)
    )
    stacked = left.unionByName(right).withColumn("matched_ts_ms", F.max("_at").over(before))
    return stacked.where("_side = 1 AND matched_ts_ms IS NOT NULL").select(
        "_row.*", "matched_ts_ms"
    )
