"""Benchmark decontamination: Wu-Manber search for word windows of benchmark items in documents.

Symbols are words. A block is two neighbouring words; a shift table says how far a search may jump
after seeing a block, so most positions are never looked at. Where the shift is zero, the bucket of
that block holds the patterns ending with it, and a comparison of all words confirms an occurrence.

The tables of a small benchmark are shipped to the documents. A larger one never leaves the tasks: its
windows are cut into rows, a bit filter of fixed size picks the document windows that may be among them, and
a join by hash finds those that are.

Defined cases: a null or empty text has no words and no hit; an item without words has no window; an
item of fewer words than a window is one window; an item without id marks words, but is not listed;
an empty item table marks nothing. Repeated documents and items give repeated rows and one listed id.
Words are told apart by 64-bit hashes, ten of them for a window.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder
from . import words as W

#: Benchmarks of at most this many bytes of ids and texts are searched by tables, others by a join.
BLOCK_BYTES = 1 << 20
FILTER_BITS = 26  # of a place in the filter of the join: 8 MB
PAGE_BITS = 15  # of a place in a row of the filter
LANE = 128
FOUND = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _pairs(hashes: np.ndarray, size: int) -> np.ndarray:
    """For each position the hash of the block that ends there."""
    if size == 1:
        return hashes
    block = np.zeros(len(hashes), dtype=np.uint64)
    block[1:] = W.mix(hashes[:-1] * W.U64(3) + hashes[1:])
    return block


class Patterns:
    """The search tables for distinct windows of one length."""

    def __init__(self, windows: np.ndarray, items: list[tuple[str, ...]]):
        count, self.length = windows.shape
        self.block = min(2, self.length)
        blocks = _pairs(windows.reshape(-1), self.block).reshape(count, -1)[:, self.block - 1 :]
        self.bits = max(12, int(np.ceil(np.log2(max(len(np.unique(blocks)) * 8, 2)))))
        widest = self.length - self.block + 1
        self.shift = np.full(1 << self.bits, widest, dtype=np.min_scalar_type(widest))
        for end in range(self.block - 1, self.length):
            place = self.place(_pairs(windows[:, : end + 1].reshape(-1), self.block)[end :: end + 1])
            np.minimum.at(self.shift, place, self.length - 1 - end)
        tail = self.place(_pairs(windows.reshape(-1), self.block)[self.length - 1 :: self.length])
        order = np.lexsort([*windows.T[::-1], tail])
        self.windows, self.items = windows[order], [items[i] for i in order]
        self.bucket = np.searchsorted(tail[order], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def place(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks >> W.U64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End positions of occurrences and the pattern of each."""
        place = self.place(_pairs(hashes, self.block))
        begin, stop = first[:-1] + self.length - 1, first[1:]
        lanes = np.maximum(-(-(stop - begin) // LANE), 0)
        text = np.repeat(np.arange(len(begin)), lanes)
        step = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = begin[text] + step * LANE
        stop = np.minimum(at + LANE, stop[text])
        zero = []
        while len(at):
            jump = self.shift[place[at]]
            zero.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        ends = np.concatenate(zero) if zero else np.zeros(0, np.int64)
        low, high = self.bucket[place[ends]], self.bucket[place[ends] + 1]
        for offset in range(self.length):  # words in order narrow the sorted bucket, like a lookup
            word = hashes[ends - self.length + 1 + offset]
            column = self.windows[:, offset]
            low, high = _between(column, word, low, high)
            some = low < high
            ends, low, high = ends[some], low[some], high[some]
        return ends, low


def _between(column: np.ndarray, word: np.ndarray, low: np.ndarray, high: np.ndarray):
    """The part of ``column[low:high]``, ascending there, that equals ``word``."""
    ends = []
    for upper in (False, True):
        left, right = low.copy(), high.copy()
        while (open_ := left < right).any():
            middle = (left + right) // 2
            value = column[np.minimum(middle, len(column) - 1)]
            right_of = ((value <= word) if upper else (value < word)) & open_
            left = np.where(right_of, middle + 1, left)
            right = np.where(open_ & ~right_of, middle, right)
        ends.append(left)
    return ends[0], ends[1]


def patterns(items: list[tuple[str | None, str | None]], window: int) -> list[Patterns]:
    """Search tables for the windows of some items, one per window length."""
    texts = pa.record_batch({"text": pa.array([text for _, text in items], pa.string())})
    found = W.batch_words(texts, "text", W.ALPHANUMERIC)
    hashes = found.hashes()
    owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for index, (item, _) in enumerate(items):
        own = hashes[found.first[index] : found.first[index + 1]].tolist()
        for at in range(max(len(own) - window + 1, 1) if own else 0):
            known = owners[tuple(own[at : at + window])]
            if item is not None:
                known.add(item)
    by_length = defaultdict(list)
    for key in owners:
        by_length[len(key)].append(key)
    return [
        Patterns(np.array(keys, dtype=np.uint64), [tuple(sorted(owners[key])) for key in keys])
        for _, keys in sorted(by_length.items())
    ]


def _mark(batch: pa.RecordBatch, tables: list[Patterns]) -> pa.RecordBatch:
    found = W.batch_words(batch, "text", W.ALPHANUMERIC)
    hashes = found.hashes()
    edges = np.zeros(len(hashes) + 1, dtype=np.int32)
    listed: dict[int, set[str]] = defaultdict(set)
    for table in tables:
        ends, which = table.find(hashes, found.first)
        np.add.at(edges, ends - table.length + 1, 1)
        np.add.at(edges, ends + 1, -1)
        owner = np.searchsorted(found.first, ends, side="right") - 1
        for text, pattern in set(zip(owner.tolist(), which.tolist())):
            listed[text].update(table.items[pattern])
    hit = (np.cumsum(edges[:-1]) > 0).astype(np.uint8)
    old = batch.column("marks").to_pylist()
    marks = []
    for text in range(batch.num_rows):
        own = hit[found.first[text] : found.first[text + 1]]
        if old[text] is not None:
            own = own | np.unpackbits(np.frombuffer(old[text], np.uint8), count=len(own))
        marks.append(np.packbits(own).tobytes() if own.any() else None)
    items = [
        sorted(listed[text].union(before or ()))
        for text, before in enumerate(batch.column("items").to_pylist())
    ]
    return pa.record_batch(
        [batch.column("row"), batch.column("text"), pa.array(marks, pa.binary()),
         pa.array(items, pa.list_(pa.string()))],
        names=["row", "text", "marks", "items"],
    )


def _summary(batch: pa.RecordBatch) -> pa.RecordBatch:
    n_words = W.batch_words(batch, "text", W.ALPHANUMERIC).counts()
    n_hit = [
        0 if m is None else int(np.unpackbits(np.frombuffer(m, np.uint8)).sum())
        for m in batch.column("marks").to_pylist()
    ]
    items = batch.column("items").to_pylist()
    return pa.record_batch(
        {
            "row": batch.column("row"),
            "n_words": pa.array(n_words, pa.int64()),
            "n_hit": pa.array(n_hit, pa.int64()),
            "n_items": pa.array([len(i) for i in items], pa.int64()),
            "items_sha256": pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]),
            "contaminated": pa.array([n > 0 for n in n_hit]),
        }
    )


def _runs(found: W.Words, hashes: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size the positions where that many words of one text begin, and hashes of these words."""
    owner = found.owner()
    value = np.zeros(len(hashes), dtype=np.uint64)
    for step in range(min(max(sizes, default=0), len(hashes))):
        value = W.mix(value[: len(hashes) - step] + hashes[step:] * W.U64(2 * step + 3))
        if step + 1 in sizes:
            at = np.flatnonzero(owner[: len(value)] == owner[step:])
            yield step + 1, at, value[at]


def _proof(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A second hash of the ``size`` words from each position."""
    value = np.zeros(len(at), dtype=np.uint64)
    for step in range(size):
        value = W.mix((value ^ hashes[at + step]) * W.U64(4 * step + 5) + W.U64(size))
    return value


def _item_windows(window: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, "text")):
            found = W.batch_words(batch, "text", W.ALPHANUMERIC)
            hashes, owner, counts = found.hashes(), found.owner(), found.counts()
            for size, at, key in _runs(found, hashes, list(range(1, window + 1))):
                own = (counts[owner[at]] == size) | (size == window)
                at, key = at[own], key[own]
                yield pa.record_batch(
                    {
                        "item": batch.column("item").take(pa.array(owner[at])),
                        "size": pa.array(np.full(len(at), size, np.int32)),
                        "key": pa.array(key.view(np.int64)),
                        "proof": pa.array(_proof(hashes, at, size).view(np.int64)),
                    }
                )

    return windows


def _met(sizes: list[int], bits):
    """Windows of documents that pass the filter, a broadcast of its bytes."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint8)
        for batch in (part for whole in batches for part in W.slices(whole, "text")):
            found = W.batch_words(batch, "text", W.ALPHANUMERIC)
            hashes, owner = found.hashes(), found.owner()
            for size, at, key in _runs(found, hashes, sizes):
                for turn in range(2):
                    place = (key >> W.U64(turn * FILTER_BITS)) & W.U64((1 << FILTER_BITS) - 1)
                    on = (table[place >> W.U64(3)] >> (place & W.U64(7)).astype(np.uint8)) & 1 > 0
                    at, key = at[on], key[on]
                yield pa.record_batch(
                    {
                        "document": batch.column("document").take(pa.array(owner[at])),
                        "at": pa.array((at - found.first[owner[at]]).astype(np.int32)),
                        "size": pa.array(np.full(len(at), size, np.int32)),
                        "key": pa.array(key.view(np.int64)),
                        "proof": pa.array(_proof(hashes, at, size).view(np.int64)),
                    }
                )

    return met


def _filter(windows: DataFrame) -> bytes:
    """Two bits for each window, in as many bytes for any number of windows."""
    places = [F.shiftrightunsigned("key", turn * FILTER_BITS).bitwiseAND((1 << FILTER_BITS) - 1) for turn in range(2)]
    pages = (
        windows.select(F.explode(F.array(*places)).alias("place"))
        .groupBy(F.shiftright("place", PAGE_BITS).alias("page"))
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND((1 << PAGE_BITS) - 1)).alias("bits"))
    )
    size = 1 << PAGE_BITS - 3
    table = bytearray(1 << FILTER_BITS - 3)
    for page, bits in pages.toLocalIterator():
        table[page * size : (page + 1) * size] = bits
    return bytes(table)


def _joined(texts: DataFrame, items: DataFrame, window: int, work: str) -> DataFrame:
    """``document``, ``n_hit``, ``n_items`` and ``items_sha256`` of the texts that hold a window of an item."""
    spark = texts.sparkSession
    schema = "size int, key long, proof long"
    items.mapInArrow(_item_windows(window), f"item string, {schema}").write.parquet(f"{work}/windows")
    windows = spark.read.parquet(f"{work}/windows")
    sizes = [r["size"] for r in windows.select("size").distinct().collect()]  # at most one per window length
    bits = spark.sparkContext.broadcast(_filter(windows))
    texts.mapInArrow(_met(sizes, bits), f"document long, at int, {schema}").write.option(
        "compression", "zstd"
    ).parquet(f"{work}/met")
    bits.unpersist()
    met = spark.read.parquet(f"{work}/met")
    by = ["size", "key", "proof"]
    windows.join(met.select(*by).distinct(), by, "left_semi").groupBy(*by).agg(
        F.sort_array(F.collect_set("item")).alias("items")
    ).write.parquet(f"{work}/owners")  # a table on one side lets the join split frequent windows
    owners = spark.read.parquet(f"{work}/owners").withColumn("owners", F.xxhash64("items"))
    hits = (
        met.join(owners, by)
        .groupBy("document", "owners")  # the items of a passage once, not for each of its windows
        .agg(F.first("items").alias("items"), F.collect_set(F.struct("at", "size")).alias("places"))
        .groupBy("document")
        .agg(F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("places")).alias("places"))
    )
    marked = F.transform("places", lambda p: F.sequence(p["at"], p["at"] + p["size"] - 1))
    listed = F.sort_array(F.array_distinct("items"))
    return hits.select(
        "document",
        F.size(F.array_distinct(F.flatten(marked))).cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in W.slices(whole, "text")):
        n_words = W.batch_words(batch, "text", W.ALPHANUMERIC).counts()
        columns = {c: batch.column(c) for c in ("row", "n_hit", "n_items", "items_sha256", "contaminated")}
        yield pa.record_batch({"row": columns.pop("row"), "n_words": pa.array(n_words, pa.int64()), **columns})


def with_contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """All columns of every document, and what ``contamination`` finds (columns of these names are
    replaced).

    With a benchmark of at most ``block_bytes`` documents are scanned where they lie, without a shuffle.
    With a larger one only hashes of windows that pass a filter are shuffled, and what is found of a text is
    joined to all documents of that text.
    """
    kept = documents.drop(*FOUND)
    texts = documents.select(
        F.struct(*[F.col(c) for c in kept.columns]).alias("row"), F.col("text").cast("string")
    )
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string"))
    result = T.StructType([T.StructField("row", kept.schema)])
    for name, kind in zip(FOUND, ("long", "long", "long", "string", "boolean")):
        result = result.add(name, kind)
    weight = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in ("item", "text")) + 8
    if (items.agg(F.sum(weight)).first()[0] or 0) <= block_bytes:
        tables = patterns([tuple(r) for r in items.collect()], window)
        found = texts.withColumns(
            {"marks": F.lit(None).cast("binary"), "items": F.array().cast("array<string>")}
        ).mapInArrow(
            lambda batches: (_summary(_mark(s, tables)) for b in batches for s in W.slices(b, "text")), result
        )
        return found.select("row.*", *FOUND)
    spark = documents.sparkSession
    work = shared_folder(spark, "decontamination")
    keyed = texts.withColumn("document", F.xxhash64("text"))
    _joined(keyed.select("document", "text"), items, window, work).write.parquet(f"{work}/found")
    found = keyed.join(spark.read.parquet(f"{work}/found"), "document", "left").select(
        "row", "text",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_hit", "n_items")],
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
    return found.mapInArrow(_counted, result).select("row.*", *FOUND)


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per document its words, those inside occurrences of benchmark windows, and the items they are of."""
    found = with_contamination(documents.select("doc_id", "text"), benchmark, window, block_bytes)
    return found.select(F.col("doc_id").cast("long"), *FOUND)
