"""Approximate nearest neighbours on shifted space-filling curves.

Each curve projects all vectors to a few dimensions of its own, shifts them, and ranks them by Hilbert key:
the keys of all curves are ranged in one sort. A query meets, on each curve, the window of ranks around its
own that holds ``window`` of all vectors; windows of all curves merge, and exact distances rank what is in
them. Vectors without structure need wide windows (a third of them for a recall of 0.9 at 64 dimensions);
clustered ones do with narrow ones. The window is a share, so recall does not fall as a corpus grows.

Ranks are cut into blocks, neighbouring queries of a curve are bundled up to a fixed number, and a task
compares one bundle with one block, so its memory does not depend on the corpus.

Of equal vectors only the ``k + 1`` with the smallest ids are candidates: no others can be among the
nearest, and a frequent vector cannot crowd a window. Of equal queries one is searched, for ``k + 1``
neighbours, itself among them; each copy takes the first ``k`` of these that are not its own row.

Defined cases: rows without id and vectors that are null, empty, zero, of other than the most frequent
length, or hold null or non-finite components take no part; rows are told apart by vec_id: of rows with
one id the smallest vector counts, and none is its own neighbour; ties go to the smaller id; an empty table gives no rows; fewer candidates than
``k`` give all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import hilbert

CURVES, DIMENSIONS, BITS = 4, 8, 7
WINDOW = 0.38
BLOCK_ROWS = 2048
BUNDLE_ROWS = 4096  # ranks whose queries are bundled, and most queries of a bundle


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector")
    ).filter("vec_id IS NOT NULL AND size(vector) > 0")
    sound = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(sound & F.exists("vector", lambda x: x != 0)).withColumn("length", F.size("vector"))
    usual = rows.groupBy("length").count().orderBy(F.desc("count"), "length").first()
    return rows.filter(F.col("length") == (usual["length"] if usual else 0)).drop("length")


def _projections(length: int, curves: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthogonal directions per curve, as far as they go round, and shifts in units of spread."""
    random = np.random.Generator(np.random.PCG64(97))
    dims = min(DIMENSIONS, length)
    columns: list[np.ndarray] = []
    while len(columns) < curves * dims:
        columns.extend(np.linalg.qr(random.standard_normal((length, length)))[0].T)
    matrix = np.array(columns[: curves * dims]).reshape(curves, dims, length)
    return matrix, random.uniform(-0.5, 0.5, (curves, dims))


def _keyed(length: int, curves: int):
    matrix, shifts = _projections(length, curves)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), length)
            norm = np.linalg.norm(vectors, axis=1, keepdims=True)
            points = vectors / np.where(norm > 0, norm, 1) * np.sqrt(length)
            for curve in range(curves):
                cells = hilbert.even_cells(points @ matrix[curve].T + shifts[curve], BITS)
                yield pa.record_batch(
                    {
                        "curve": pa.array(np.full(batch.num_rows, curve), pa.int32()),
                        "key": pa.array(hilbert.keys(cells, BITS)),
                        **{c: batch.column(c) for c in ("vec_id", "candidate", "query")},
                    }
                )

    return keyed


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, length)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates and queries of the partition before each row."""
    past = {"candidate": 0, "query": 0}
    for batch in batches:
        columns = {c: batch.column(c) for c in ("part", "curve", "vec_id", "candidate", "query")}
        for flag, name in (("candidate", "before"), ("query", "asked")):
            flags = batch.column(flag).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = past[flag] + np.cumsum(flags)
            columns[name] = pa.array(ends - flags, pa.int64())
            past[flag] = int(ends[-1]) if len(ends) else past[flag]
        yield pa.record_batch(columns)


def ranks(rows: DataFrame, work: str, length: int, curves: int) -> tuple[DataFrame, int]:
    """The rank of each row among the candidates of each curve, its part of the order and the queries before
    it there, and the number of candidates."""
    spark = rows.sparkSession
    by = ["curve", "key", "vec_id"]
    (
        rows.mapInArrow(
            _keyed(length, curves), "curve int, key long, vec_id long, candidate boolean, query boolean"
        )
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(
            _counted,
            "part int, curve int, vec_id long, candidate boolean, query boolean, before long, asked long",
        )
        .write.parquet(f"{work}/ranks")
    )
    found = spark.read.parquet(f"{work}/ranks")
    counts = found.groupBy("part").agg(F.count_if("candidate").alias("n")).orderBy("part").collect()
    base, total = [], 0  # one entry per partition
    for part, n in counts:
        base.append((part, total))
        total += n
    each = total // curves
    bases = spark.createDataFrame(base, "part int, base long")
    rank = F.col("before") + F.col("base") - F.col("curve") * F.lit(each)
    placed = found.join(F.broadcast(bases), "part").withColumn("rank", rank)
    return placed.select("curve", "vec_id", "candidate", "query", "rank", "part", "asked"), each


def bundled(placed: DataFrame, rows: int) -> DataFrame:
    """Neighbouring queries of a curve, at most ``rows`` together: ``bundle`` and its ``low`` and ``high``."""
    return (
        placed.filter("query")
        .groupBy("curve", F.floor(F.col("rank") / rows).alias("at"), "part", F.floor(F.col("asked") / rows).alias("lot"))
        .agg(
            F.collect_list(F.struct("vec_id", "rank", "vector")).alias("bundle"),
            F.min("rank").alias("low"), F.max("rank").alias("high"),
        )
        .select("curve", "bundle", "low", "high")
    )


def _nearest(length: int, k: int, reach: int, total: int):
    def part(struct: pa.StructArray):
        return (
            struct.field("vec_id").to_numpy(), struct.field("rank").to_numpy(),
            _matrix(struct.field("vector"), length),
        )

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, places, vectors = part(batch.column("block")[row].values)
                queries, at, wanted = part(batch.column("bundle")[row].values)
                low = np.clip(at - reach, 0, max(total - 2 * reach - 1, 0))
                found: tuple[list, list, list] = ([], [], [])
                for query, start, vector in zip(queries, low, wanted):
                    inside = np.flatnonzero((places >= start) & (places <= start + 2 * reach))
                    if not len(inside):
                        continue
                    score = np.sqrt(((vectors[inside] - vector) ** 2).sum(axis=1))
                    if len(inside) > k:
                        limit = np.partition(score, k - 1)[k - 1]
                        close = score <= limit
                        inside, score = inside[close], score[close]
                    best = np.lexsort((ids[inside], score))[:k]
                    found[0].append(np.full(len(best), query))
                    found[1].append(ids[inside][best])
                    found[2].append(score[best])
                if found[0]:
                    flat = [np.concatenate(x) for x in found]
                    yield pa.record_batch(
                        [pa.array(flat[0]), pa.array(flat[1]), pa.array(flat[2])],
                        names=["query_id", "vec_id", "score"],
                    )

    return nearest


def neighbours(
    vectors: DataFrame, queries: Column, work: str, k: int = 10, curves: int = CURVES, window: float = WINDOW
) -> DataFrame:
    """The ``k`` nearest found of each row for which ``queries`` holds: ``query_id, rank, vec_id, score``
    (Euclidean distance). ``work`` is an empty shared folder."""
    rows = usable(vectors)
    same = Window.partitionBy("vector").orderBy("vec_id")
    one_each = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    kept = one_each.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1)
    asking = one_each.filter(queries)
    asked = asking.groupBy("vector").agg(F.min("vec_id").alias("vec_id"))
    marked = (
        kept.select("vec_id", F.col("vector").alias("own"), F.lit(True).alias("candidate"))
        .join(asked.withColumn("query", F.lit(True)), "vec_id", "full")
        .select(
            "vec_id", F.coalesce("own", "vector").alias("vector"),
            F.coalesce("candidate", F.lit(False)).alias("candidate"), F.coalesce("query", F.lit(False)).alias("query"),
        )
    )
    marked.write.parquet(f"{work}/vectors")
    marked = vectors.sparkSession.read.parquet(f"{work}/vectors")
    sample = marked.select(F.size("vector").alias("n")).first()
    length = sample["n"] if sample else 1
    placed, total = ranks(marked, work, length, curves)
    reach = int(np.ceil(window * total / 2))
    placed = placed.join(marked.select("vec_id", "vector"), "vec_id")
    item = F.struct("vec_id", "rank", "vector")
    blocks = (
        placed.filter("candidate")
        .groupBy("curve", F.floor(F.col("rank") / BLOCK_ROWS).alias("place"))
        .agg(F.collect_list(item).alias("block"))
    )
    low = F.least(F.greatest(F.col("low") - reach, F.lit(0)), F.lit(max(total - 2 * reach - 1, 0)))
    high = F.greatest(F.col("high") + reach, F.lit(2 * reach))
    bundles = bundled(placed, BUNDLE_ROWS).withColumn("place", F.explode(F.sequence(
        F.floor(low / BLOCK_ROWS), F.floor(F.least(high, F.lit(max(total - 1, 0))) / BLOCK_ROWS)
    )))
    found = (
        bundles.join(blocks, ["curve", "place"])
        .select("block", "bundle")
        .mapInArrow(_nearest(length, k + 1, reach, total), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    answers = (
        found.groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k + 1)
        .groupBy(F.col("query_id").alias("vec_id"))
        .agg(F.sort_array(F.collect_list(F.struct("score", F.col("vec_id").alias("id")))).alias("answers"))
        .join(marked.filter("query").select("vec_id", "vector"), "vec_id")
        .select("vector", "answers")
    )
    answers.write.parquet(f"{work}/answers")  # tables on one side let the join split frequent vectors
    answers = vectors.sparkSession.read.parquet(f"{work}/answers")
    others = F.slice(F.filter("answers", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (
        asking.withColumnRenamed("vec_id", "query_id")
        .join(answers, "vector")
        .select("query_id", F.posexplode(others).alias("at", "found"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("found.id").alias("vec_id"), "found.score")
    )
