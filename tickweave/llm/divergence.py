"""How far the sources of a language differ in their words, with strings materialised late.

Terms move as 64-bit digests only. A first pass over the texts counts, per language and digest, the documents
that hold it; the kept ones mark a bit filter of fixed size. A second pass sends, of what passes the filter,
the occurrences per language, source and digest, and once per task the string behind a digest. Per digest the
smallest and the largest string are taken: where they differ, several terms share the digest, and those
digests alone are counted again by their strings, which splits them into numbered terms. Text is joined back
only to rows that come out.

With c occurrences of a term among N of all kept terms of a group, and V kept terms in its language, the group
gives it ``p = 1 + floor(10**9 * (c + 5) / (N + 5 V))``. Two sources differ by the sum of ``|p - q|`` over
all kept terms; a term stands out in a source where its p exceeds that of the whole language.

Counts are added up within a task before they are shuffled, and keyed by language, source and digest, so a
hot source or a frequent word is one row per task. Vectors of all sources of a language are held for a
bundle of terms at a time; the sums per pair of sources grow with the result's own rows.

Defined cases: null text, language and source count as empty strings; every row is a document, repeated rows
too; a group without kept terms takes part with counts of zero; a language without kept terms gives its pairs
with value zero and no terms; a single source has no pairs; an empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W

TERMS = W.not_in((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
POOL = 1 << 20
STRINGS = 1 << 18
FILTER_BITS = 26
BUNDLE_TERMS = 1024
CELLS = 1 << 21
SUMS = 1 << 22
SCALE, SMOOTHING = 1_000_000_000, 5

_COUNTS = "lang string, source string, digest long, term string, n long, docs long"


class _Groups:
    """Numbers for the languages and sources that a task meets."""

    def __init__(self, columns: list[str]):
        self.columns, self.number, self.names = columns, {}, []

    def of(self, part: pa.RecordBatch) -> np.ndarray:
        out = []
        for names in zip(*(part.column(c).to_pylist() for c in self.columns)):
            if names not in self.number:
                self.number[names] = len(self.names)
                self.names.append(names)
            out.append(self.number[names])
        return np.array(out, dtype=np.int64)

    def arrays(self, numbers: np.ndarray) -> list[pa.Array]:
        """The names of some groups, a column each; a missing source column is null."""
        found = []
        for at in range(2):
            names = pa.array([name[at] if at < len(name) else None for name in self.names], pa.string())
            found.append(pa.DictionaryArray.from_arrays(pa.array(numbers, pa.int32()), names).cast(pa.string()))
        return found


def _added(rows: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Rows of group, digest and counts with equal group and digest added up."""
    group, digest, *counts = (np.concatenate(column) for column in zip(*rows))
    order = np.lexsort((digest, group))
    group, digest = group[order], digest[order]
    fresh = np.ones(len(group), dtype=bool)
    fresh[1:] = (group[1:] != group[:-1]) | (digest[1:] != digest[:-1])
    at = np.flatnonzero(fresh)
    return [group[at], digest[at], *(np.add.reduceat(c[order], at) if len(at) else c for c in counts)]


def _digests(found: W.Words, digest_bits: int) -> np.ndarray:
    return found.hashes() >> W.U64(64 - digest_bits)


def _batch(groups: _Groups, group: np.ndarray, digest: np.ndarray, n: np.ndarray, docs, terms=None):
    lang, source = groups.arrays(group)
    return pa.record_batch(
        {
            "lang": lang, "source": source, "digest": pa.array(digest.view(np.int64)),
            "term": pa.nulls(len(group), pa.string()) if terms is None else pa.array(terms, pa.string()),
            "n": pa.array(n, pa.int64()), "docs": pa.array(docs, pa.int64()),
        }
    )


def _document_counts(digest_bits: int):
    """Per language and digest the documents that hold it, as far as a task has seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, pool, size = _Groups(["lang"]), [], 0

        def emptied():
            group, digest, docs = _added(pool)
            return _batch(groups, group, digest, docs, docs)

        for batch in batches:
            for part in W.slices(batch, "text"):
                found = W.batch_words(part, "text", TERMS)
                value, bounds = W.distinct(_digests(found, digest_bits), found.owner(), part.num_rows)
                own = np.repeat(groups.of(part), np.diff(bounds))
                pool.append(_added([[own, value, np.ones(len(value), np.int64)]]))
                size += len(pool[-1][0])
                if size > POOL:
                    yield emptied()
                    pool, size = [], 0
        if size:
            yield emptied()

    return count


def _marked(digests: DataFrame, digest_bits: int) -> np.ndarray:
    """A bit per leading bits of a digest, set for the given ones: at most 2 ** (FILTER_BITS - 6) words
    come to the driver, whatever the number of digests."""
    bits = min(FILTER_BITS, digest_bits)
    lead = F.shiftrightunsigned("digest", digest_bits - bits)
    word, bit = F.shiftrightunsigned(lead, 6).alias("word"), lead.bitwiseAND(F.lit(63)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    rows = digests.groupBy(word).agg(F.bit_or(mask).alias("mask")).toArrow()
    words = np.zeros(max(1 << bits >> 6, 1), dtype=np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return words


def _passes(digest: np.ndarray, words: np.ndarray, digest_bits: int) -> np.ndarray:
    lead = digest >> W.U64(digest_bits - min(FILTER_BITS, digest_bits))
    return words[(lead >> W.U64(6)).astype(np.int64)] >> (lead & W.U64(63)) & W.U64(1) > 0


def _unlike(found: W.Words, at: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Which of the words ``at`` differ in their bytes from the words ``like``."""
    size = found.end[at] - found.start[at]
    unlike = size != found.end[like] - found.start[like]
    same = np.flatnonzero(~unlike)
    size = size[same]
    first = np.cumsum(size) - size
    step = np.arange(int(size.sum())) - np.repeat(first, size)
    one = found.data[np.repeat(found.start[at[same]], size) + step]
    two = found.data[np.repeat(found.start[like[same]], size) + step]
    unlike[same] = np.add.reduceat(one != two, first) > 0 if len(same) else False
    return unlike


def _kept_counts(marks, digest_bits: int):
    """Per language, source and digest the occurrences of digests that pass the filter, and rows without
    language for the strings behind digests: all that a task has met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, pool, size = _Groups(["lang", "source"]), [], 0
        strings: dict[int, bytes] = {}
        twins: set[tuple[int, bytes]] = set()  # further strings of a digest

        def emptied():
            group, digest, n = _added(pool)
            yield _batch(groups, group, digest, n, n)
            terms = [*strings.items(), *twins]
            ids = np.array([d for d, _ in terms], dtype=np.uint64)
            none = pa.nulls(len(terms), pa.string())
            zero = pa.array(np.zeros(len(terms), np.int64))
            yield pa.record_batch(
                [none, none, pa.array(ids.view(np.int64)), pa.array([t.decode() for _, t in terms], pa.string()), zero, zero],
                names=["lang", "source", "digest", "term", "n", "docs"],
            )

        for batch in batches:
            for part in W.slices(batch, "text"):
                found = W.batch_words(part, "text", TERMS)
                digest = _digests(found, digest_bits)
                at = np.flatnonzero(_passes(digest, marks.value, digest_bits))
                if not len(at):
                    continue
                digest, own = digest[at], groups.of(part)[found.owner()[at]]
                pool.append(_added([[own, digest, np.ones(len(at), np.int64)]]))
                size += len(pool[-1][0])
                seen, first, which = np.unique(digest, return_index=True, return_inverse=True)
                for d, text in zip(seen.tolist(), found.spelled(at[first])):
                    if strings.setdefault(d, text) != text:
                        twins.add((d, text))
                odd = _unlike(found, at, at[first[which]])
                twins.update(zip(digest[odd].tolist(), found.spelled(at[odd])))
                if size > POOL or len(strings) + len(twins) > STRINGS:
                    yield from emptied()
                    pool, size, strings, twins = [], 0, {}, set()
        if size:
            yield from emptied()

    return count


def _spelled_counts(marks, digest_bits: int):
    """Occurrences and documents per language, source, digest and string of digests that pass the filter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, n, docs = _Groups(["lang", "source"]), Counter(), Counter()

        def emptied():
            rows = list(n)
            yield _batch(
                groups, np.array([g for g, _, _ in rows], np.int64), np.array([d for _, d, _ in rows], np.uint64),
                np.array([n[r] for r in rows], np.int64), np.array([docs[r] for r in rows], np.int64),
                [t.decode() for _, _, t in rows],
            )

        for batch in batches:
            for part in W.slices(batch, "text"):
                found = W.batch_words(part, "text", TERMS)
                digest, owner = _digests(found, digest_bits), found.owner()
                at = np.flatnonzero(_passes(digest, marks.value, digest_bits))
                group = groups.of(part)
                keys = [*zip(owner[at].tolist(), group[owner[at]].tolist(), digest[at].tolist(), found.spelled(at))]
                n.update(key[1:] for key in keys)
                docs.update(key[1:] for key in {*keys})
                if len(n) > STRINGS:
                    yield from emptied()
                    n, docs = Counter(), Counter()
        if n:
            yield from emptied()

    return count


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(10**9 * (count + 5) / total)``, exact for counts below 9 * 10**15."""
    rest = np.asarray(count, dtype=np.int64) + SMOOTHING
    found = np.zeros(np.broadcast(rest, total).shape, dtype=np.int64)
    found, rest = rest // total, rest % total
    for _ in range(3):  # three digits at a time: no product leaves 64 bits
        found, rest = found * 1000 + rest * 1000 // total, rest * 1000 % total
    return found + 1


def _share(count: Column, total: Column) -> Column:
    """The same as an expression."""
    exact = F.call_function("div", (count + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), total.cast("decimal(20,0)"))
    return exact.cast("long") + 1


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of |p - q| over the terms of bundles, per language and source: a row of all its partners."""
    sums: dict[str, np.ndarray] = {}

    def emptied():
        for lang, own in sums.items():
            yield pa.record_batch(
                {
                    "lang": pa.array([lang] * len(own), pa.string()),
                    "place": pa.array(np.arange(len(own)), pa.int32()),
                    "sums": pa.array(list(own), pa.list_(pa.int64())),
                }
            )

    for batch in batches:
        for row in range(batch.num_rows):
            lang = batch.column("lang")[row].as_py()
            total = batch.column("totals")[row].values.to_numpy()
            cells = batch.column("cells")[row].values
            term = np.stack([cells.field(c).to_numpy() for c in ("digest", "number")])
            order = np.lexsort(term)
            fresh = np.any(np.diff(term[:, order], axis=1, prepend=-1) != 0, axis=0)
            fresh[0] = True
            term = np.cumsum(fresh) - 1
            place, n = (cells.field(c).to_numpy()[order] for c in ("place", "n"))
            if sum(len(own) ** 2 for own in sums.values()) + len(total) ** 2 > SUMS:
                yield from emptied()
                sums = {}
            own = sums.setdefault(lang, np.zeros((len(total), len(total)), dtype=np.int64))
            step = max(CELLS // len(total), 1)
            for low in range(0, int(term[-1]) + 1, step):
                a, b = np.searchsorted(term, [low, low + step])
                counts = np.zeros((min(step, int(term[-1]) + 1 - low), len(total)), dtype=np.int64)
                counts[term[a:b] - low, place[a:b]] = n[a:b]
                p = share(counts, total)
                for i in range(len(total)):
                    own[i] += np.abs(p - p[:, i : i + 1]).sum(axis=0)
    yield from emptied()


def divergence(
    documents: DataFrame, work: str, min_docs: int = 30, terms: int = 50, digest_bits: int = 64
) -> DataFrame:
    """The rows ``lang, source, part, item, value, rank``: part ``pair`` holds every other source of the
    language, part ``term`` the first ``terms`` terms that stand out. A term is kept if at least ``min_docs``
    documents of its language hold it. ``work`` is an empty shared folder."""
    spark = documents.sparkSession
    rows = documents.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    )

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    def enough(frame: DataFrame, *keys: str) -> DataFrame:
        found = frame.groupBy(*keys).agg(F.sum("docs").alias("docs"))
        return found.filter(F.col("docs") >= min_docs).select(*keys)

    seen = rows.select("lang", "text").mapInArrow(_document_counts(digest_bits), _COUNTS)
    often = kept(enough(seen, "lang", "digest"), "often")
    marks = spark.sparkContext.broadcast(_marked(often.select("digest"), digest_bits))
    counted = kept(rows.mapInArrow(_kept_counts(marks, digest_bits), _COUNTS), "counted")
    names = counted.filter("lang IS NULL").groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("last"))
    names = kept(names.join(often.select("digest").distinct(), "digest"), "names")
    shared = names.filter("term < last").select("digest")
    cells = counted.filter("lang IS NOT NULL").groupBy("lang", "digest", "source").agg(F.sum("n").alias("n"))
    cells = cells.join(often, ["lang", "digest"]).select("lang", "source", "digest", F.lit(0).alias("number"), "n")
    names = names.filter("term = last").select("digest", F.lit(0).alias("number"), "term")
    if not shared.isEmpty():
        twins = spark.sparkContext.broadcast(_marked(shared, digest_bits))
        spelled = rows.mapInArrow(_spelled_counts(twins, digest_bits), _COUNTS).join(shared, "digest", "left_semi")
        spelled = spelled.groupBy("lang", "digest", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        spelled = kept(spelled, "spelled")
        own = enough(spelled, "lang", "digest", "term")
        numbers = own.select("digest", "term").distinct().withColumn(
            "number", F.row_number().over(Window.partitionBy("digest").orderBy("term"))
        )
        numbers = kept(numbers, "numbers")
        split = spelled.join(own, ["lang", "digest", "term"]).join(numbers, ["digest", "term"])
        cells = cells.join(shared, "digest", "left_anti").select("lang", "source", "digest", "number", "n").unionByName(
            split.select("lang", "source", "digest", "number", "n")
        )
        names = names.unionByName(numbers.select("digest", "number", "term"))
    cells = kept(cells, "cells")

    # figures of terms, groups and languages; each is small against the cells
    term = ["lang", "digest", "number"]
    totals = kept(cells.groupBy(*term).agg(F.sum("n").alias("all_n")), "totals")
    sizes = totals.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("all_total"))
    groups = (
        rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents"))
        .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
        .join(sizes, "lang", "left")
    )
    groups = kept(
        groups.select(
            "lang", "source", F.coalesce("v", F.lit(0)).alias("v"),
            (F.coalesce("n", F.lit(0)) + SMOOTHING * F.col("v")).alias("total"),
            (F.col("all_total") + SMOOTHING * F.col("v")).alias("all_total"),
        ),
        "groups",
    )

    # pairs: all sources of a language side by side, a bundle of terms at a time
    listed = groups.filter("v > 0").groupBy("lang", "v").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("sources"))
    places = listed.select("lang", "v", F.posexplode("sources").alias("place", "own")).select("lang", "v", F.col("own.source").alias("source"), "place")
    bundle = F.pmod(F.xxhash64("digest", "number"), F.ceil(F.col("v") / BUNDLE_TERMS)).alias("bundle")
    bundles = (
        cells.join(places, ["lang", "source"]).groupBy("lang", bundle)
        .agg(F.collect_list(F.struct("digest", "number", "place", "n")).alias("cells"))
        .join(listed.select("lang", F.col("sources.total").alias("totals")), "lang")
    )
    sums = bundles.mapInArrow(_distances, "lang string, place int, sums array<long>")
    sums = sums.select("lang", "place", F.posexplode("sums").alias("other", "value"))
    sums = sums.groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))
    one = places.select("lang", "source", "place")
    two = places.select("lang", F.col("source").alias("item"), F.col("place").alias("other"))
    sums = sums.join(one, ["lang", "place"]).join(two, ["lang", "other"]).select("lang", "source", "item", "value")
    partner = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(partner, "lang").filter("source <> item")
    pairs = pairs.join(sums, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    # terms: ranked by digest with all ties, then spelled
    p, q = _share(F.col("n"), F.col("total")), _share(F.col("all_n"), F.col("all_total"))
    ahead = cells.join(totals, term).join(groups, ["lang", "source"]).withColumn("value", p - q).filter("value > 0")
    ahead = ahead.select("lang", "source", "digest", "number", "value")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    ahead = ahead.withColumn("rank", F.rank().over(by_value)).filter(F.col("rank") <= terms).drop("rank")
    spoken = ahead.join(names, ["digest", "number"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.unionByName(spoken).withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= terms))
