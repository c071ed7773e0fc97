"""Tick and gap identity: dedupe, insert-or-ignore, poll baseline.

A tick is identified within its trading day by (symbol, seq), or without a seq by (symbol, ts_ms,
price, volume, turnover). A seq-less tick with a NULL among those parts equals no other tick. Rows
lacking a required column are never stored.

Keys are made of plain non-NULL columns, so a window and an anti join over them share one shuffle.
A ``row_number() = 1`` filter is pruned on the map side (window group limit), so a key that holds a
large share of all rows shrinks to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import GAP_KEY, TICK_REQUIRED

ARRIVAL = ("recv_ts_ms", "ingest_ordinal")
_KEY = ("trading_day", "symbol", "_has_seq", "_seq", "_ts", "_price", "_volume", "_turnover")


def storable(ticks: DataFrame) -> Column:
    cond = F.lit(True)
    for name in TICK_REQUIRED:
        if name in ticks.columns:
            cond = cond & F.col(name).isNotNull()
    return cond


def never_duplicate() -> Column:
    """A seq-less tick with an unknown price, volume or turnover."""
    return F.col("seq").isNull() & (
        F.col("price").isNull() | F.col("volume").isNull() | F.col("turnover").isNull()
    )


def with_key(ticks: DataFrame, arrival: Sequence[str] = ()) -> DataFrame:
    """Adds the key columns, none of them NULL.

    Prices and turnovers enter as text: as exact as the double, and without the normalising of
    floating-point keys that would keep a window and a join from sharing their shuffle (adding zero
    unites -0.0 and 0.0). With ``arrival``, a never-duplicate row carries its arrival in place of the
    price and so differs from every other row.
    """
    has_seq = F.col("seq").isNotNull()

    def part(name: str, zero) -> Column:
        return F.when(has_seq, F.lit(zero)).otherwise(F.coalesce(F.col(name), F.lit(zero)))

    def number_text(name: str) -> Column:
        return F.coalesce((F.col(name) + F.lit(0.0)).cast("string"), F.lit(""))

    price = number_text("price")
    if arrival:
        own = F.concat_ws("|", F.lit("alone"), *[F.col(c).cast("string") for c in arrival])
        price = F.when(never_duplicate(), own).otherwise(price)
    return ticks.select(
        "*",
        has_seq.alias("_has_seq"),
        F.coalesce("seq", F.lit(0)).cast("bigint").alias("_seq"),
        part("ts_ms", 0).cast("bigint").alias("_ts"),
        F.when(has_seq, "").otherwise(price).alias("_price"),
        part("volume", 0).cast("bigint").alias("_volume"),
        F.when(has_seq, "").otherwise(number_text("turnover")).alias("_turnover"),
    )


def clean_numbers(ticks: DataFrame) -> DataFrame:
    """NaN prices and turnovers are stored as NULL."""
    fix = lambda n: F.when(~F.isnan(n), F.col(n))
    return ticks.withColumns({"price": fix("price"), "turnover": fix("turnover")})


def dedupe_ticks(ticks: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """First arrival per key. ``arrival`` must order the rows totally."""
    return _first_per_key(ticks, arrival).select(*ticks.columns)


def _first_per_key(ticks: DataFrame, arrival: Sequence[str]) -> DataFrame:
    keyed = with_key(clean_numbers(ticks).where(storable(ticks)), arrival)
    first = Window.partitionBy(*_KEY).orderBy(*arrival)
    return keyed.withColumn("_rn", F.row_number().over(first)).where("_rn = 1")


def dedupe_counts(ticks: DataFrame) -> DataFrame:
    """Per day: rows offered, rows kept by ``dedupe_ticks``, rows ignored. Two partial aggregations,
    so copies collapse before the shuffle."""
    cleaned = clean_numbers(ticks)
    per_key = (
        with_key(cleaned)
        .withColumns({"_storable": storable(cleaned), "_alone": never_duplicate()})
        .groupBy(*_KEY, "_storable", "_alone")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    kept = F.when(~F.col("_storable"), 0).when(F.col("_alone"), F.col("_n")).otherwise(1)
    return (
        per_key.groupBy("trading_day")
        .agg(F.sum("_n").alias("batch"), F.sum(kept).cast("bigint").alias("inserted"))
        .withColumn("ignored", F.col("batch") - F.col("inserted"))
    )


def new_ticks(
    ticks: DataFrame, stored: DataFrame, arrival: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Insert-or-ignore: deduped rows whose key is not stored yet.

    ``stored`` should already be limited to the touched days. Dedupe and anti join share their key
    columns, hence one shuffle of the new rows; a never-duplicate row meets no stored key.
    """
    known = with_key(stored.where(~never_duplicate())).select(*_KEY)
    return (
        _first_per_key(ticks, arrival)
        .join(known, list(_KEY), "left_anti")
        .select(*ticks.columns)
    )


def without_copies(ticks: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows that equal no stored row in every column, NULLs included. Only rows without an identity of
    their own are compared; the others have been by their key."""
    alone = ticks.where(never_duplicate())
    columns = [c for c in stored.columns if c in ticks.columns]
    same = F.lit(True)
    kept = stored.where(never_duplicate()).select(*[F.col(c).alias(f"_s_{c}") for c in columns])
    for name in columns:
        plain = name in ("trading_day", "symbol", "ts_ms", "recv_ts_ms")
        value, other = F.col(name), F.col(f"_s_{name}")
        same = same & ((value == other) if plain else value.eqNullSafe(other))
    return ticks.where(~never_duplicate()).unionByName(alone.join(kept, same, "left_anti"))


def dedupe_gaps(gaps: DataFrame) -> DataFrame:
    """One row per gap key, the earliest detection."""
    order = Window.partitionBy(*GAP_KEY).orderBy("detected_at_ms", "trading_day")
    return gaps.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def new_gaps(gaps: DataFrame, stored: DataFrame) -> DataFrame:
    return dedupe_gaps(gaps).join(stored.select(*GAP_KEY), list(GAP_KEY), "left_anti")


def missing_keys(wanted: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``wanted`` whose key does not occur in ``known``; missing parts equal each other."""
    other = known.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return wanted.join(other, same, "left_anti")


def max_seq_by_symbol(ticks: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    rows = ticks.where(F.col("seq").isNotNull())
    if symbols is not None:
        rows = rows.where(F.col("symbol").isin(list(symbols)))
    return rows.groupBy("symbol").agg(F.max("seq").alias("max_seq"))


def flag_polled(
    polled: DataFrame,
    baseline: DataFrame,
    recent_keys: DataFrame | None = None,
    arrival: Sequence[str] = ARRIVAL,
    wanted_symbol: str | None = None,
) -> DataFrame:
    """Each polled row with its outcome: ``kept``, ``duplicate`` or ``filtered``.

    ``baseline`` is (symbol, max_seq) of what is persisted, one row per symbol. Rows at or below it
    are duplicates, as are repeats within the poll and seq-less rows whose key is in
    ``recent_keys``. The baseline side is left to the size check of the planner: small ones are
    broadcast, larger ones joined by shuffle with skewed symbols split.
    """
    wanted = F.lit(True) if wanted_symbol is None else F.col("symbol") == wanted_symbol
    base = baseline.select("symbol", F.col("max_seq").alias("_base"))
    rows = polled.join(base, "symbol", "left").withColumn("_wanted", wanted)
    rows = rows.withColumn("_old", F.coalesce(F.col("seq") <= F.col("_base"), F.lit(False)))
    key = [
        F.col("symbol"),
        F.col("seq"),
        *[F.when(F.col("seq").isNull(), F.col(c)) for c in ("ts_ms", "price", "volume", "turnover")],
    ]
    if recent_keys is not None:
        marks = recent_keys.select(
            F.col("symbol").alias("_k0"),
            F.col("ts_ms").alias("_k1"),
            F.col("price").alias("_k2"),
            F.col("volume").alias("_k3"),
            F.col("turnover").alias("_k4"),
            F.lit(True).alias("_seen"),
        ).distinct()
        on = (
            F.col("seq").isNull()
            & (F.col("symbol") == F.col("_k0"))
            & (F.col("ts_ms") == F.col("_k1"))
            & F.col("price").eqNullSafe(F.col("_k2"))
            & F.col("volume").eqNullSafe(F.col("_k3"))
            & F.col("turnover").eqNullSafe(F.col("_k4"))
        )
        rows = rows.join(marks, on, "left").drop("_k0", "_k1", "_k2", "_k3", "_k4")
        rows = rows.withColumn("_old", F.col("_old") | F.coalesce("_seen", F.lit(False))).drop(
            "_seen"
        )
    # the first arrival of a key is the row whose arrival equals the key's minimum; the minimum is
    # a partial aggregate, so repeated keys collapse before the shuffle
    first = (
        rows.where(F.col("_wanted") & ~F.col("_old"))
        .groupBy(*[k.alias(f"_f{i}") for i, k in enumerate(key)])
        .agg(F.min(F.struct(*arrival)).alias("_first"))
    )
    match = F.struct(*arrival) == F.col("_first")
    for i, k in enumerate(key):
        match = match & k.eqNullSafe(F.col(f"_f{i}"))
    firsts = rows.join(first, match, "left")
    outcome = (
        F.when(~F.col("_wanted"), "filtered")
        .when(F.col("_old") | F.col("_first").isNull(), "duplicate")
        .otherwise("kept")
    )
    return firsts.withColumn("outcome", outcome).select(*polled.columns, "outcome")


def poll_counts(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("symbol").agg(
        F.count_if(F.col("outcome") == "kept").alias("kept"),
        F.count_if(F.col("outcome") == "duplicate").alias("dropped_duplicate"),
        F.count_if(F.col("outcome") == "filtered").alias("dropped_filter"),
    )


def seq_lag(seen: DataFrame, persisted: DataFrame) -> DataFrame:
    """Seen against persisted max seq over the union of symbols; unseen symbols are left out."""
    both = seen.select("symbol", F.col("max_seq").alias("seen_seq")).join(
        persisted.select("symbol", F.col("max_seq").alias("persisted_seq")), "symbol", "full_outer"
    )
    lag = F.greatest(F.lit(0), F.col("seen_seq") - F.coalesce("persisted_seq", F.lit(0)))
    return both.where(F.col("seen_seq").isNotNull()).withColumn("seq_lag", lag.cast("bigint"))
