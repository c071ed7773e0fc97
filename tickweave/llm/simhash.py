"""Near duplicates by SimHash fingerprints, found at the words of a covering code (anchor points).

A fingerprint has a bit set where more than half of a text's shingle hashes have it. Two documents link if
their fingerprints differ in at most ``bits`` of 64. Of such a pair one half of the fingerprint differs in at
most two bits, or in at most one. Over a half, the anchors are a covering code of radius one: the words of
the perfect Hamming code of 31 bits with the 32nd bit free, 2 ** 27 of them. Any point within one of both
fingerprints has an anchor within one, so both lie within two of that anchor; and of two that differ in one
bit, the anchor next to the first lies within two of the second. Each distinct fingerprint is replicated to
all anchors within that radius, covering radius plus one, at most 17 of each half, and those that share an
anchor are compared. So no link is missed, and an anchor is as selective as a 23-bit key.

Equal fingerprints are one, so copies never meet. An anchor's fingerprints are joined into a forest: a search
visits each of them once and gives one link per fingerprint that it reaches, never all pairs. Up to
``group_limit`` meet as one array in one task. The fingerprints of a larger group, as dense clusters of near
copies have, go to the finest code instead, all words of 64 bits with covering radius zero: each goes to
the words within half of the allowed distance, any two at one word link without being compared, and each
hangs on the smallest there. That is one row per word near each fingerprint, in proportion to their number.

Defined cases: a null text counts as empty; a text without words has fingerprint zero and is linked like any
other; fewer words than a shingle are hashed as one; shingles count as often as they occur; rows with equal
ids are one document, linked by any of its texts; a document without id has a fingerprint, but no component
and no links; an empty table gives no rows. Columns other than id and text are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components

SEED = 42
GROUP_LIMIT = 16_384
SPANS = 1 << 15
#: The parity masks of the Hamming code of 31 bits: bit ``p`` stands at position ``p + 1``.
_PARITY = [np.uint32(sum(1 << p for p in range(31) if (p + 1) >> k & 1)) for k in range(5)]
#: For each syndrome, the pairs of positions whose exchange mends it.
_MENDS = [
    np.array([1 << (i - 1) | 1 << ((i ^ s) - 1) for i in range(1, 32) if i < i ^ s], dtype=np.uint32)
    for s in range(32)
]


def _spans(found: W.Words, shingle_words: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words joined by single spaces, where shingles begin and end in that, and their texts."""
    counts = found.counts()
    last = np.zeros(len(found), dtype=bool)
    last[found.first[1:][counts > 0] - 1] = True
    steps = np.zeros(len(found.data) + 1, dtype=np.int8)
    steps[found.start] += 1
    steps[found.end + ~last] -= 1
    keep = np.cumsum(steps[:-1], dtype=np.int8) > 0
    joined = found.data[keep]
    at = np.concatenate([[0], np.cumsum(keep)])
    joined[at[found.end[~last]]] = 0x20
    begin, end = at[found.start], at[found.end]
    shingles = np.where(counts > 0, np.maximum(counts - shingle_words + 1, 1), 0)
    owner = np.repeat(np.arange(len(counts)), shingles)
    first = found.first[owner] + np.arange(len(owner)) - (np.cumsum(shingles) - shingles)[owner]
    final = np.minimum(first + shingle_words, found.first[owner + 1]) - 1
    return joined.tobytes(), begin[first], end[final], owner


def fingerprints(batch: pa.RecordBatch, shingle_words: int) -> np.ndarray:
    """The fingerprint of each text of a batch."""
    raw, begin, end, owner = _spans(W.batch_words(batch, "text", W.SPACED), shingle_words)
    counts = np.zeros((batch.num_rows, 64), dtype=np.int64)
    hashed, seed = xxhash.xxh64_intdigest, SEED
    for at in range(0, len(owner), SPANS):
        part = slice(at, at + SPANS)
        places = zip(begin[part].tolist(), end[part].tolist())
        hashes = np.array([hashed(raw[a:b], seed) for a, b in places], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[part]
        fresh = np.flatnonzero(np.diff(own, prepend=-1))
        counts[own[fresh]] += np.add.reduceat(bits, fresh, axis=0, dtype=np.int32)
    total = np.bincount(owner, minlength=batch.num_rows)
    return np.packbits(2 * counts > total[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _prints(shingle_words: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                found = fingerprints(part, shingle_words).view(np.int64)
                yield pa.record_batch([part.column("doc_id"), pa.array(found)], names=["doc_id", "print"])

    return prints


def anchors_near(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchors within two bits of each 32-bit half, and which half each belongs to."""
    syndrome = np.zeros(len(half), dtype=np.uint32)
    for k, mask in enumerate(_PARITY):
        syndrome |= (np.bitwise_count(half & mask) & np.uint8(1)).astype(np.uint32) << np.uint32(k)
    off = syndrome > 0
    nearest = half ^ np.where(off, np.uint32(1) << (np.maximum(syndrome, 1) - np.uint32(1)), np.uint32(0))
    every = np.arange(len(half))
    found, owner = [nearest, nearest ^ np.uint32(1 << 31)], [every, every]
    for s in range(1, 32):
        own = np.flatnonzero(syndrome == s)
        found.append((half[own, None] ^ _MENDS[s]).ravel())
        owner.append(np.repeat(own, len(_MENDS[s])))
    return np.concatenate(found), np.concatenate(owner)


def _replicated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per fingerprint and anchor near one of its halves."""
    for batch in batches:
        prints = batch.column("print").to_numpy().view(np.uint64)
        for side in (0, 1):
            half = (prints >> W.U64(32 * side)).astype(np.uint32)
            anchor, owner = anchors_near(half)
            key = anchor.astype(np.int64) | side << 32
            yield pa.record_batch(
                [pa.array(key), pa.array(prints[owner].view(np.int64))], names=["anchor", "print"]
            )


def forest(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within distinct fingerprints that join all of them that chains of links join."""
    left = np.array(prints, dtype=np.uint64)
    found: tuple[list, list] = ([], [])
    queue: list = []
    while len(left):
        if not queue:
            queue, left = [left[-1]], left[:-1]
        at = queue.pop()
        near = np.bitwise_count(left ^ at) <= bits
        if near.any():
            reached = left[near]
            left = left[~near]
            queue.extend(reached)
            found[0].append(np.full(len(reached), at))
            found[1].append(reached)
    if not found[0]:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(found[0]), np.concatenate(found[1])


def _compared(bits: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.column("prints"):
                a, b = forest(group.values.to_numpy().view(np.uint64), bits)
                yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return compare


def _ball(radius: int):
    """A row per fingerprint and word within ``radius`` bits of it."""
    flips = [sum(1 << i for i in c) for n in range(radius + 1) for c in combinations(range(64), n)]
    flips = np.array(flips, dtype=np.uint64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy().view(np.uint64)
            for at in range(0, len(prints), 64):
                own = prints[at : at + 64]
                word = (own[:, None] ^ flips).ravel()
                own = np.repeat(own, len(flips))
                yield pa.record_batch(
                    [pa.array(word.view(np.int64)), pa.array(own.view(np.int64))], names=["word", "print"]
                )

    return spread


def links(prints: DataFrame, work: str, bits: int = 4, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links ``a, b`` between the distinct values of ``print`` that join whatever chains of pairs within
    ``bits`` bits join. ``work`` is an empty shared folder."""
    if bits not in (0, 2, 4):
        raise ValueError("fingerprints link at 0, 2 or 4 differing bits at most")
    spark = prints.sparkSession
    rows = prints.mapInArrow(_replicated, "anchor long, print long")
    sizes = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    # the planner takes replicated rows for as few as went in, so the joins are told not to broadcast
    rows.hint("merge").join(sizes, "anchor").write.parquet(f"{work}/members")
    members = spark.read.parquet(f"{work}/members")
    groups = members.filter(F.col("size") <= group_limit).groupBy("anchor")
    groups = groups.agg(F.sort_array(F.collect_list("print")).alias("prints"))
    # near copies share many anchors: equal groups are compared once
    found = groups.select("prints").distinct().mapInArrow(_compared(bits), "a long, b long")
    dense = members.filter(F.col("size") > group_limit).select("print").distinct()
    if not dense.isEmpty():
        near = dense.mapInArrow(_ball(bits // 2), "word long, print long")
        heads = near.groupBy("word").agg(F.min("print").alias("head"), F.max("print").alias("last"))
        hung = near.hint("merge").join(heads.filter("head < last").select("word", "head"), "word")
        hung = hung.filter("print <> head").select(F.col("head").alias("a"), F.col("print").alias("b"))
        found = found.unionByName(hung.distinct())
    return found


def near_duplicates(
    documents: DataFrame, work: str, shingle_words: int = 4, bits: int = 4, group_limit: int = GROUP_LIMIT
) -> DataFrame:
    """Per row of the documents its ``fingerprint`` (64 bits, as a long) and its component: the smallest id
    reachable by links. ``work`` is an empty shared folder."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows.mapInArrow(_prints(shingle_words), "doc_id long, print long").write.parquet(f"{work}/prints")
    prints = spark.read.parquet(f"{work}/prints")
    known = prints.filter("doc_id IS NOT NULL")
    known.groupBy("print").agg(F.min("doc_id").alias("id")).write.parquet(f"{work}/distinct")
    distinct = spark.read.parquet(f"{work}/distinct")
    found = links(distinct.select("print"), f"{work}/anchors", bits, group_limit)
    # the texts of one id are linked with each other
    own = known.groupBy("doc_id").agg(F.min("print").alias("a"), F.max("print").alias("z")).filter("a < z")
    own = known.join(own, "doc_id").filter("a < print").select("a", F.col("print").alias("b"))
    ends = [distinct.select(F.col("print").alias(c), F.col("id").alias(f"{c}_id")) for c in ("a", "b")]
    edges = found.unionByName(own).hint("merge").join(ends[0], "a").hint("merge").join(ends[1], "b")
    edges = edges.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    labels = components(edges, f"{work}/components").withColumnRenamed("node", "id")
    label = distinct.join(labels, "id", "left").select("print", F.coalesce("component", "id").alias("component"))
    placed = prints.join(label, "print", "left").select(
        "doc_id", F.col("print").alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id")
    )
    return placed
