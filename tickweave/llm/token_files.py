"""Token ids of a corpus in compact files: Huffman-coded blocks with bit-offset checkpoints.

A corpus folder holds ``codebook`` (the code length of each id, which fixes the canonical codes) and
``blocks``: whole documents in ascending doc_id order, coded with the one codebook of the corpus, each
block decodable on its own. ``start`` is the place of a document's first id among all ids.

Steps: documents are ranged by id and tokenized once into an intermediate table; ids are counted over
all of it; blocks are coded from it.

Defined cases: a null or empty text gives the end id alone; documents without id come first; documents
with equal ids follow each other in an order of their texts; an empty table gives no block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import huffman
from . import words as W
from .tokens import SLICE_BYTES, Coder, id_kind

#: A block is closed once it has this many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 17
PARTITION_BYTES = 16 << 20


def partitions_for(spark: SparkSession, frame: DataFrame, column: str, each: int) -> int:
    """As many partitions as hold about ``each`` bytes of a column, at least the session's width."""
    size = frame.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // each))


def tokenized(
    documents: DataFrame, tokenizer: str, cut: str, end_id: int, kind: str, partitions: int
) -> DataFrame:
    """Ids per document in doc_id order: ``part`` numbers the ranges, ``before`` the ids in the same
    range that come earlier."""
    ordered = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = ordered.repartitionByRange(partitions, *by).sortWithinPartitions(*by)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            for part in W.slices(batch, "text", SLICE_BYTES):
                ids, bounds = Coder.get(tokenizer, cut).ids(part.column("text"), end_id)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "part": part.column("part"),
                        "before": pa.array(before + bounds[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                        "ids": W.binary(ids.astype(kind), bounds),
                    }
                )
                before += int(bounds[-1])

    return ordered.withColumn("part", F.spark_partition_id()).mapInArrow(
        encode, "doc_id long, part int, before long, n_tokens long, ids binary"
    )


def id_counts(tokens: DataFrame, kind: str, vocabulary: int) -> np.ndarray:
    """How often each id occurs; the driver gets one row per id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            data, _ = W.buffers(batch.column("ids"))
            total += np.bincount(data.view(kind), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    rows = tokens.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n"))
    counts = np.zeros(vocabulary, dtype=np.int64)
    for id_, n in rows.collect():
        counts[id_] = n
    return counts


def write(
    documents: DataFrame, path: str, work: str, tokenizer: str, vocabulary: int, cut: str, end_id: int,
    partition_bytes: int = PARTITION_BYTES, block_ids: int = BLOCK_IDS, limit: int = huffman.LIMIT,
) -> None:
    """Write a corpus folder to ``path``; ``work`` is an empty shared folder. Codes have at most ``limit``
    bits, or as many more as the number of different ids takes."""
    spark = documents.sparkSession
    kind = id_kind(vocabulary)
    width = partitions_for(spark, documents, "text", partition_bytes)
    plain = tokenized(documents, tokenizer, cut, end_id, kind, width)
    plain.write.option("compression", "zstd").parquet(f"{work}/ids")
    plain = spark.read.parquet(f"{work}/ids")
    counts = id_counts(plain, kind, vocabulary)
    book = huffman.Codebook(huffman.code_lengths(counts, huffman.least_limit(counts, limit)))
    ends = plain.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, total = {}, 0  # one entry per partition
    for part, n in ends:
        base[part], total = total, total + n
    lengths = [(int(i), int(book.lengths[i])) for i in np.flatnonzero(book.lengths)]
    spark.createDataFrame(lengths, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")

    def block(rows: list[tuple]) -> dict:
        ids = np.concatenate([np.frombuffer(r[3], kind) for r in rows])
        bits, marks = book.encode(ids)
        return {
            "first": rows[0][1], "doc_ids": [r[0] for r in rows], "sizes": [r[2] for r in rows],
            "checkpoints": marks.tolist(), "bits": bits,
        }

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
             ("checkpoints", pa.list_(pa.int64())), ("bits", pa.binary())]
        )
        rows, held, last = [], 0, None
        for batch in batches:
            parts = batch.column("part").to_pylist()
            starts = batch.column("before").to_numpy()
            for i, (doc, part, n) in enumerate(zip(
                batch.column("doc_id").to_pylist(), parts, batch.column("n_tokens").to_pylist()
            )):
                if rows and (part != last or held + n > block_ids):
                    yield pa.RecordBatch.from_pylist([block(rows)], schema)
                    rows, held = [], 0
                rows.append((doc, base[part] + int(starts[i]), n, batch.column("ids")[i].as_py()))
                held, last = held + n, part
        if rows:
            yield pa.RecordBatch.from_pylist([block(rows)], schema)

    plain.mapInArrow(
        encode,
        "first long, doc_ids array<long>, sizes array<long>, checkpoints array<long>, bits binary",
    ).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a corpus folder: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (little-endian unsigned
    32-bit integers)."""
    rows = spark.read.schema("id int, bits int").parquet(f"{path}/codebook").collect()  # a row per id
    lengths = np.zeros(max((r["id"] for r in rows), default=-1) + 1, dtype=np.uint8)
    for id_, bits in rows:
        lengths[id_] = bits
    book = huffman.Codebook(lengths)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 8):
                part = batch.slice(at, 8)
                sizes = part.column("sizes")
                n = sizes.flatten().to_numpy()
                per_block = np.array([sum(s) for s in sizes.to_pylist()], dtype=np.int64)
                marks = [np.array(m, dtype=np.int64) for m in part.column("checkpoints").to_pylist()]
                ids = book.decode(part.column("bits").to_pylist(), marks, per_block)
                bounds = np.concatenate([[0], np.cumsum(n)])
                blocks = np.repeat(np.arange(part.num_rows), [len(s) for s in sizes.to_pylist()])
                shift = part.column("first").to_numpy() - (np.cumsum(per_block) - per_block)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_ids").flatten().cast(pa.int64()),
                        "start": pa.array(bounds[:-1] + shift[blocks], pa.int64()),
                        "n_tokens": pa.array(n, pa.int64()),
                        "ids": W.binary(ids, bounds),
                    }
                )

    return spark.read.parquet(f"{path}/blocks").mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids binary"
    )
