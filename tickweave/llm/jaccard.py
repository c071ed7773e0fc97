"""Exact Jaccard self-join of word-shingle sets by parity sketches.

A text's distinct shingles are dealt to blocks by their hash, and each block keeps the XOR of its shingles'
64-bit hashes. A shingle that only one of two sets has changes one block, so the number of differing
blocks never exceeds the size of the symmetric difference. Sets are compared within size bands; in band
``j`` linked sets differ in at most ``D`` shingles, so of ``D + 1 + spare`` blocks at least ``1 + spare``
agree. Texts meet on equal blocks (pigeonhole). Blocks of fewer than ``MIN_LOAD`` shingles are left out as
join keys, unless a text has more than ``spare`` of them: then it joins on all of its blocks, which keeps
the join exact. The same count says how many keys a text shares with any that it is linked to; a text that
shares fewer, with all others together, goes. Candidates pass a finer parity sketch, of one bit per hash, and are verified on the whole
sets.

Equal sets are one class, joined once through its smallest document. Within the group of an equal block
only the most shared text is first compared with the others, so the members of a group of near copies do
not meet in pairs. What then still lies in different components of a group is compared through the finer
sketches: bundles of bounded size meet in one task, which passes on only pairs whose Hamming distance
allows a link. No link between different texts is lost.

Defined cases: a text without words has an empty set, linked with nothing; a document without id has no
component; rows with equal ids are one document, linked by any of its texts; equal sets are linked; an
empty table gives no rows. Shingles are told apart by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_folder
from . import words as W
from .components import components

BAND_GROWTH = 1.5
BUNDLE = 256
MIN_LOAD = 2


class Bands:
    """Size bands for a threshold in percent and the block numbers of their sketches."""

    def __init__(self, percent: int):
        if not 70 <= percent <= 100:
            raise ValueError("the threshold is 70 to 100 percent")
        edges = [1]
        while edges[-1] < 1 << 31:
            edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_GROWTH)))
        self.edges = np.array(edges, dtype=np.int64)
        largest = self.edges[1:] - 1
        self.differ = largest * (100 - percent) // percent
        self.partner = largest * 100 // percent
        self.spare = np.zeros_like(largest)
        self.load = np.ones_like(largest)
        for band, differ in enumerate(self.differ):
            middle = (self.edges[band] + largest[band]) / 2
            for load in range(MIN_LOAD, 0, -1):
                spare = self._spare(int(differ), middle, load)
                if spare is not None:
                    self.spare[band], self.load[band] = spare, load
                    break
        self.blocks = self.differ + 1 + self.spare

    @staticmethod
    def _spare(differ: int, size: float, load: int) -> int | None:
        """Enough spare blocks for nearly all texts of a size, or None if that takes too many."""
        steps = np.unique(np.linspace(0, max(differ // 3, 3), 200).astype(np.int64))
        mean = size / (differ + 1 + steps)
        light = (differ + 1 + steps) * np.exp(-mean) * (1 + mean if load == 2 else 1)
        enough = np.flatnonzero(light + 2.5 * np.sqrt(light) <= steps + 0.5)
        return int(steps[enough[0]]) if len(enough) else None

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, size, side="right") - 1


@lru_cache(maxsize=4)
def bands_for(percent: int) -> Bands:
    return Bands(percent)


def shingle_sets(batch: pa.RecordBatch, shingle_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, and where each text's begin."""
    found = W.batch_words(batch, "text", W.SPACED)
    return W.distinct(*W.sequences(found, found.hashes(), shingle_words), batch.num_rows)


def _block_keys(
    value: np.ndarray, bounds: np.ndarray, band: np.ndarray, differ: np.ndarray, bands: Bands
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join keys of the sets whose ``band`` is not negative, where each text's begin, and the number of
    keys that each text shares with any text linked to it in this band, at the least. ``differ``: the most
    shingles in which a linked text can differ."""
    size = np.where(band >= 0, np.diff(bounds), 0)
    blocks = np.where(band >= 0, bands.blocks[band], 0)
    first = np.cumsum(blocks) - blocks
    inside = np.repeat(band >= 0, np.diff(bounds))
    value = value[inside]
    owner = np.repeat(np.arange(len(size)), size)
    block = first[owner] + ((value >> W.U64(32)) * blocks[owner].astype(np.uint64) >> W.U64(32)).astype(
        np.int64
    )
    total = int(blocks.sum())
    sketch = np.zeros(total, dtype=np.uint64)
    fresh = np.flatnonzero(np.diff(block, prepend=-1))
    if len(fresh):
        sketch[block[fresh]] = np.bitwise_xor.reduceat(W.mix(value + W.U64(77)), fresh)
    text = np.repeat(np.arange(len(size)), blocks)
    light = np.bincount(block, minlength=total) < bands.load[band[text]]
    hard = np.bincount(text, light, len(size)) > np.where(band >= 0, bands.spare[band], 0)
    place = np.arange(total) - first[text]
    keys = W.mix(sketch + W.mix((band[text].astype(np.uint64) << W.U64(40)) + place.astype(np.uint64)))
    chosen = ~light | hard[text]
    shared = blocks - differ - np.bincount(text, light, len(size)).astype(np.int64)
    return (
        keys[chosen], np.searchsorted(text[chosen], np.arange(len(size) + 1)), np.maximum(shared, 1)
    )


def _prints(shingle_words: int):
    """Size, 128-bit print and bit sketch of each text's set."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                value, bounds = shingle_sets(part, shingle_words)
                bits = [parity_bits(value[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        **_identity(value, bounds),
                        "bits": pa.array(bits, pa.binary()),
                    }
                )

    return prints


def _identity(value: np.ndarray, bounds: np.ndarray) -> dict[str, pa.Array]:
    found = {"n_shingles": pa.array(np.diff(bounds), pa.int64())}
    for salt, name in ((1, "print_a"), (2, "print_b")):
        sums = np.concatenate([[W.U64(0)], np.cumsum(W.mix(value * W.U64(2) + W.U64(salt)))])
        found[name] = pa.array((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return found


def _block_sketches(shingle_words: int, percent: int):
    """The join keys of each text, packed."""
    bands = bands_for(percent)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                value, bounds = shingle_sets(part, shingle_words)
                size = np.diff(bounds)
                own = bands.of(size)
                below = np.maximum(own - 1, 0)
                lower = (own >= 1) & (size <= bands.partner[below]) & (bands.differ[below] > 0)
                own = np.where((own >= 0) & (bands.differ[own] > 0), own, -1)
                most = np.minimum(bands.differ[own], size * (100 - percent) // percent)
                columns = {"doc_id": part.column("doc_id"), **_identity(value, bounds)}
                for side, band, differ in (
                    (0, own, most),
                    (1, np.where(lower, below, -1), bands.differ[below]),
                ):
                    keys, edges, least = _block_keys(value, bounds, band, differ, bands)
                    columns[f"keys_{side}"] = W.binary(keys, edges)
                    columns[f"least_{side}"] = pa.array(least, pa.int64())
                yield pa.record_batch(columns)

    return sketch


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for side in (0, 1):
            data, offsets = W.buffers(batch.column(f"keys_{side}"))
            ids = np.repeat(batch.column("id").to_numpy(), np.diff(offsets) // 8)
            keys = data.view(np.int64)
            for at in range(0, len(keys), 200_000):
                part = slice(at, at + 200_000)
                sides = np.full(len(keys[part]), side, dtype=np.int32)
                yield pa.record_batch(
                    [pa.array(keys[part]), pa.array(ids[part]), pa.array(sides)], names=["key", "id", "side"]
                )


def parity_bits(value: np.ndarray) -> np.ndarray:
    """A set's bit sketch: each hash flips one of at least four bits per element, a power of two of them.
    A sketch folds to half its length by XOR of its halves."""
    width = 1 << max(int(4 * len(value) - 1).bit_length(), 6)
    flips = np.bincount((W.mix(value) & W.U64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little")


def _sets(shingle_words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                value, bounds = shingle_sets(part, shingle_words)
                yield pa.record_batch({"id": part.column("doc_id"), "shingles": W.binary(value, bounds)})

    return sets


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _close_pairs(percent: int):
    """Pairs of different components of two bundles whose sketches allow a link."""

    def read(bundle: pa.StructArray):
        n = bundle.field("n").to_numpy()
        order = np.argsort(n, kind="stable")
        bits = bundle.field("bits")
        return (
            bundle.field("id").to_numpy()[order], bundle.field("component").to_numpy()[order], n[order],
            [np.frombuffer(bits[int(i)].as_buffer(), np.uint8) for i in order],
        )

    def one(left, right) -> tuple[np.ndarray, np.ndarray]:
        ids, components_, sizes, sketches = left
        ends = np.array([len(s) for s in sketches])
        found: tuple[list, list] = ([], [])
        for other, component, size, sketch in zip(*right):
            low = np.searchsorted(sizes * 100, size * percent, side="left")
            high = np.searchsorted(sizes * percent, size * 100, side="right")
            for length in np.unique(ends[low:high]):
                at = low + np.flatnonzero(ends[low:high] == length)
                at = at[(components_[at] != component) & (ids[at] != other)]
                if not len(at):
                    continue
                width = min(int(length), len(sketch))
                many = np.stack([_folded(sketches[i], width) for i in at])
                differ = np.bitwise_count(many ^ _folded(sketch, width)).sum(axis=1, dtype=np.int64)
                both = sizes[at] + size
                near = at[100 * (both - differ) >= percent * (both + differ)]
                found[0].append(np.minimum(ids[near], other))
                found[1].append(np.maximum(ids[near], other))
        if not found[0]:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found[0]), np.concatenate(found[1])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                left, right = (read(batch.column(c)[row].values) for c in ("members", "others"))
                a, b = one(left, right)
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return close


def _possible(percent: int):
    """Pairs whose sketches allow a link."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            sizes = batch.column("left_n").to_numpy() + batch.column("right_n").to_numpy()
            for both, *sketches in zip(sizes, batch.column("left_bits"), batch.column("right_bits")):
                left, right = (np.frombuffer(s.as_buffer(), np.uint8) for s in sketches)
                width = min(len(left), len(right))
                differ = int(np.bitwise_count(_folded(left, width) ^ _folded(right, width)).sum())
                kept.append(100 * (both - differ) >= percent * (both + differ))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return possible


def _verified(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column("left_set"), batch.column("right_set")):
                left, right = (np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))
                both = np.concatenate([left, right])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                linked.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return verify


def near_duplicates(
    documents: DataFrame, work: str, shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """Per document the size of its shingle set and its component: the smallest id reachable by links.

    Two documents link when 100 * intersection >= percent * union. ``work`` is an empty shared folder.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    same = ["n_shingles", "print_a", "print_b"]
    identity = "doc_id long, n_shingles long, print_a long, print_b long"
    prints = kept(rows.mapInArrow(_prints(shingle_words), f"{identity}, bits binary"), "prints")
    classes = kept(
        prints.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*same)
        .agg(F.min("doc_id").alias("id")),
        "classes",
    )
    # the keys of one document per class; they move once packed, and as rows below
    packed = ["keys_0", "least_0", "keys_1", "least_1"]
    chosen = rows.mapInArrow(
        _block_sketches(shingle_words, percent),
        f"{identity}, keys_0 binary, least_0 long, keys_1 binary, least_1 long",
    ).join(classes.select(F.col("id").alias("doc_id"), *same), ["doc_id", *same])
    chosen = kept(chosen.select(F.col("doc_id").alias("id"), *packed), "keys")
    keys = chosen.mapInArrow(_unpacked, "key long, id long, side int")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    groups = kept(keys.join(shared.select("key"), "key").distinct(), "groups")
    sizes = classes.groupBy("id").agg(F.min("n_shingles").alias("fewest"), F.max("n_shingles").alias("most"))
    # who shares fewer keys, with all texts together, than a linked text would share has no link there
    least = chosen.groupBy("id").agg(F.min("least_0").alias("least_0"), F.min("least_1").alias("least_1"))
    enough = F.col("fame") >= F.when(F.col("side") == 0, F.col("least_0")).otherwise(F.col("least_1"))
    fame = groups.groupBy("id", "side").agg(F.count(F.lit(1)).alias("fame"))
    fame = fame.join(least, "id").filter(enough).select("id", "side", "fame").join(sizes, "id")
    members = kept(groups.join(fame, ["id", "side"]).drop("side"), "members")
    delete_folder(spark, f"{work}/keys")  # the largest table, not needed any more
    bits = kept(
        prints.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bits").join(
            members.select("id").distinct(), "id", "left_semi"
        ),
        "bits",
    )

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """Those of the pairs ``a < b`` that link, by the whole sets of just these documents."""
        ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
        ids = kept(ids.distinct(), f"{name}-ids")  # a table's size is known: few ids move no texts
        texts = rows.join(ids, "doc_id", "left_semi")
        sets = kept(texts.mapInArrow(_sets(shingle_words), "id long, shingles binary"), f"{name}-sets")
        sides = [
            sets.select(F.col("id").alias(c), F.col("shingles").alias(f"{side}_set"))
            for c, side in (("a", "left"), ("b", "right"))
        ]
        both = pairs.join(sides[0], "a").join(sides[1], "b")
        return both.select("a", "b", "left_set", "right_set").mapInArrow(
            _verified(percent), "a long, b long"
        ).distinct()

    # rows with one id join the classes of their texts
    member = prints.select("doc_id", *same).join(classes, same).select("doc_id", "id").distinct()
    first = member.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z")
    links = member.join(first, "doc_id").filter("a < id").select("a", F.col("id").alias("b"))
    stars = kept(_star_pairs(members, bits, percent), "star-pairs")
    links = kept(links.unionByName(linked(stars, "star")), "star-links")
    labels = components(links, f"{work}/star-components")
    rest = kept(_rest_pairs(members, labels, bits, percent), "rest-pairs")
    found = kept(linked(rest, "rest"), "rest-links")
    if not found.isEmpty():
        labels = components(links.unionByName(found), f"{work}/components")
    placed = (
        prints.select("doc_id", *same)
        .join(classes, same, "left")
        .join(labels.withColumnRenamed("node", "id"), "id", "left")
    )
    own = placed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "id", "doc_id")).alias("component_id")
    )
    return prints.select("doc_id", "n_shingles").join(own, "doc_id", "left")


def _star_pairs(members: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Each member of a block's group with the group's most shared text, if sizes and sketches allow a
    link: pairs ``a < b``."""
    heads = members.groupBy("key").agg(
        F.max(F.struct("fame", "id", "fewest", "most")).alias("head")
    )
    near = (F.col("most") * 100 >= F.col("head.fewest") * percent) & (
        F.col("head.most") * 100 >= F.col("fewest") * percent
    )
    pairs = members.join(heads, "key").filter(near & (F.col("id") != F.col("head.id")))
    pairs = pairs.select(
        F.least("id", "head.id").alias("a"), F.greatest("id", "head.id").alias("b")
    ).distinct()
    sides = [
        bits.select(F.col("id").alias(c), F.col("n").alias(f"{s}_n"), F.col("bits").alias(f"{s}_bits"))
        for c, s in (("a", "left"), ("b", "right"))
    ]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    return both.select("a", "b", "left_n", "left_bits", "right_n", "right_bits").mapInArrow(
        _possible(percent), "a long, b long"
    ).distinct()


def _rest_pairs(members: DataFrame, labels: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a < b`` of one block's group that lie in different components and whose sketches allow a
    link; pairs with the group's most shared text are decided already.

    Groups of equal members, as near copies have by the dozen, are looked into once. All their members, in
    bundles, meet those outside the component of the most shared one.
    """
    labelled = members.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    heads = labelled.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.max(F.struct("fame", "id", "component")).alias("head")
    ).filter("size > 2")
    others = labelled.select("key", "id", "component").join(heads, "key").filter("id <> head.id")
    groups = others.groupBy("key").agg(
        F.min("component").alias("first"),
        F.max("component").alias("last"),
        F.first("head.component").alias("main"),
        F.count(F.lit(1)).alias("size"),
        *[F.sum(F.xxhash64(F.lit(salt), "id").cast("decimal(20,0)")).alias(f"s{salt}") for salt in (1, 2)],
    ).filter("first < last")
    once = groups.groupBy("size", "main", "s1", "s2").agg(F.min("key").alias("key")).select(
        "key", "main", F.ceil(F.col("size") / BUNDLE).alias("bundles")
    )
    rows = others.select("key", "id", "component").join(once, "key").join(bits, "id")
    item = F.struct("id", "component", "n", "bits")
    bundle = F.pmod(F.xxhash64("id"), "bundles")
    left = rows.groupBy("key", bundle.alias("bundle")).agg(F.collect_list(item).alias("members"))
    right = rows.filter("component <> main").groupBy("key", bundle.alias("other_bundle")).agg(
        F.collect_list(item).alias("others")
    )
    return left.join(right, "key").select("members", "others").mapInArrow(
        _close_pairs(percent), "a long, b long"
    ).distinct()
