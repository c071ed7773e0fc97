"""Connected components by alternating large and small stars, each round written to a shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang the neighbours of each node on its smallest neighbour: the larger ones, or the smaller ones
    and the node itself."""
    if larger:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    # written edges compress well, so their files look small enough to broadcast when the rows are not
    joined = sides.hint("merge").join(least, "a")
    if larger:
        hung = joined.filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        hung = joined.select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(
            joined.select("a", F.col("root").alias("b"))
        )
    return hung.filter("a <> b").distinct()


def components(edges: DataFrame, work: str) -> DataFrame:
    """``node, component`` for all nodes of the edges ``a, b``: the smallest node that is reachable.

    Roots that have no larger neighbour but themselves are included. ``work`` is an empty shared folder.
    """
    spark = edges.sparkSession
    edges = edges.filter("a <> b").select("a", "b").distinct()
    before = None
    for turn in range(1_000):
        path = f"{work}/{turn}"
        _stars(_stars(edges, True), False).write.parquet(path)
        edges = spark.read.parquet(path)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
