"""Packing along a space-filling curve: like documents share sequences, and nothing is padded.

A document's words are hashed into a vector, the vector is projected to a few dimensions, and its Hilbert
key orders the documents. All ids in that order are one run, cut every ``length`` ids; what remains at the
end of the corpus is cut into powers of two, which need no padding. Only slim rows (key, size) are sorted;
ids move once, to meet the place that their document got.

Defined cases: a null or empty text gives the end id alone; texts without words lie at the middle of the
curve; repeated documents are neighbours, in the order of their rows in the intermediate table; an empty
table gives no piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hilbert
from . import words as W
from .tokens import SLICE_BYTES, Coder, id_kind

VECTOR = 256
DIMENSIONS = 4
BITS = 12
_PROJECTION = np.random.Generator(np.random.PCG64(811)).standard_normal((VECTOR, DIMENSIONS))


def curve_keys(batch: pa.RecordBatch) -> np.ndarray:
    """The Hilbert key of each text's projected hash vector."""
    found = W.batch_words(batch, "text", W.SPACED)
    hashes = found.hashes()
    place = found.owner() * VECTOR + (hashes % W.U64(VECTOR)).astype(np.int64)
    sign = np.where(hashes >> W.U64(63), 1.0, -1.0)
    vector = np.bincount(place, sign, batch.num_rows * VECTOR).astype(float).reshape(-1, VECTOR)
    norm = np.linalg.norm(vector, axis=1, keepdims=True)
    vector = np.divide(vector, norm, out=np.zeros_like(vector), where=norm > 0)
    return hilbert.keys(hilbert.even_cells(vector @ _PROJECTION, BITS), BITS)


def tokenized(documents: DataFrame, tokenizer: str, cut: str, end_id: int, kind: str) -> DataFrame:
    """Ids and curve key per document, without a shuffle."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", SLICE_BYTES):
                ids, bounds = Coder.get(tokenizer, cut).ids(part.column("text"), end_id)
                keys = np.concatenate([curve_keys(s) for s in W.slices(part, "text")])
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "key": pa.array(keys, pa.int64()),
                        "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                        "ids": W.binary(ids.astype(kind), bounds),
                    }
                )
        Coder.get(tokenizer, cut).kept.clear()  # a worker may go on to other stages

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        encode, "doc_id long, key long, n_tokens long, ids binary"
    )


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = 0
    for batch in batches:
        sizes = batch.column("n_tokens").to_numpy()
        ends = before + np.cumsum(sizes)
        yield pa.record_batch(
            {
                "place": batch.column("place"),
                "part": batch.column("part"),
                "before": pa.array(ends - sizes, pa.int64()),
                "n": batch.column("n_tokens"),
            }
        )
        before = int(ends[-1]) if len(ends) else before


class Cuts:
    """Where sequences begin in a run of ``total`` ids."""

    def __init__(self, total: int, length: int):
        self.full, rest = divmod(total, length)
        self.length = length
        powers = [1 << b for b in range(length.bit_length(), -1, -1) if rest >> b & 1]
        self.tail = self.full * length + np.cumsum([0, *powers])

    def sequence(self, at: np.ndarray) -> np.ndarray:
        late = np.searchsorted(self.tail, at, side="right") - 1
        return np.where(at < self.tail[0], at // self.length, self.full + late)

    def begin(self, sequence: np.ndarray) -> np.ndarray:
        late = np.clip(sequence - self.full, 0, len(self.tail) - 1)
        return np.where(sequence < self.full, sequence * self.length, self.tail[late])


def pack(
    documents: DataFrame, work: str, tokenizer: str, vocabulary: int, cut: str, end_id: int,
    length: int = 1024,
) -> DataFrame:
    """Pieces of documents in sequences: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``;
    ``ids`` are little-endian unsigned 32-bit integers. ``work`` is an empty shared folder."""
    spark: SparkSession = documents.sparkSession
    kind = id_kind(vocabulary)
    tokenized(documents, tokenizer, cut, end_id, kind).withColumn(
        "place", F.monotonically_increasing_id()
    ).write.option("compression", "zstd").parquet(f"{work}/ids")
    tokens = spark.read.parquet(f"{work}/ids")
    by = ["key", "place"]
    (
        tokens.select("place", "key", "n_tokens")
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(_running, "place long, part int, before long, n long")
        .write.parquet(f"{work}/order")
    )
    order = spark.read.parquet(f"{work}/order")
    base, total = [], 0  # one entry per partition of the curve
    for part, n in order.groupBy("part").agg(F.sum("n")).orderBy("part").collect():
        base.append((part, total))
        total += n
    bases = spark.createDataFrame(base, "part int, base long")
    starts = order.join(F.broadcast(bases), "part").select(
        "place", (F.col("before") + F.col("base")).alias("at")
    )
    cuts = Cuts(total, length)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.buffers(batch.column("ids"))
            ids = data.view(kind).astype("<u4")
            first = offsets // np.dtype(kind).itemsize
            at = batch.column("at").to_numpy()
            size = np.diff(first)
            low, high = cuts.sequence(at), cuts.sequence(at + size - 1)
            count = high - low + 1
            doc = np.repeat(np.arange(batch.num_rows), count)
            sequence = low[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.maximum(at[doc], cuts.begin(sequence))
            end = np.minimum((at + size)[doc], cuts.begin(sequence + 1))
            start = begin - at[doc]
            bounds = np.append(first[doc] + start, first[-1])
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(doc)),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(end - begin, pa.int64()),
                    "ids": W.binary(ids, bounds),
                    "doc_tokens": pa.array(size[doc], pa.int64()),
                    "sequence_id": pa.array(sequence, pa.int64()),
                    "offset": pa.array(begin - cuts.begin(sequence), pa.int64()),
                }
            )

    return tokens.select("place", "doc_id", "ids").join(starts, "place").drop("place").mapInArrow(
        pieces,
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
