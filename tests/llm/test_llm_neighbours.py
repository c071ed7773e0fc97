import numpy as np
from pyspark.sql import functions as F

from tickweave.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label string, rank string, part string"


def searched(spark, rows, folder, **settings):
    frame = spark.createDataFrame([(i, v, "x", None, "y") for i, v in rows], SCHEMA)
    got = ann.neighbours(frame, F.col("vec_id") % 100 == 0, folder, **settings).collect()
    result = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        result.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return result


def exact(rows, k=10):
    usable = [(i, np.array(v, np.float64)) for i, v in rows]
    result = {}
    for i, v in usable:
        if i % 100 == 0:
            far = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in usable if j != i)
            result[i] = [(j, d) for d, j in far[:k]]
    return result


def test_recall_against_all_rows(spark, folder):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    got, want = searched(spark, rows, folder()), exact(rows)
    assert got.keys() == want.keys()
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert hits / sum(len(v) for v in want.values()) >= 0.9
    for i, found in got.items():
        known = dict((j, np.array(v, np.float64)) for j, v in rows)
        for j, score in found:
            assert abs(score - np.sqrt(((known[i] - known[j]) ** 2).sum())) < 1e-12


def test_whole_window_is_exact_with_ties_and_frequent_vectors(spark, folder):
    source = np.random.default_rng(8)
    rows = [(i, source.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(300, 520)]
    got, want = searched(spark, rows, folder(), window=2.0), exact(rows)
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}


def test_odd_vectors_take_no_part(spark, folder):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [0.5, 0.5]), (9, [0.5, 0.5]),
        (100, None), (200, [0.0, 0.0]),
    ]
    got = searched(spark, rows, folder("a"))
    assert {i: [j for j, _ in v] for i, v in got.items()} == {0: [9, 1]}
    assert searched(spark, [], folder("b")) == {}
    assert searched(spark, [(0, [1.0, 0.0])], folder("c")) == {}


def test_equal_queries_are_searched_once_in_bounded_bundles(spark, folder, monkeypatch):
    source = np.random.default_rng(9)
    rows = [(i, source.normal(size=4).astype(np.float32).tolist()) for i in range(300)]
    rows += [(100 * i, [1.0, 0.0, 0.0, 0.0]) for i in range(3, 3000)]
    rows += [(100 * i, [float(i % 90 + 2), 0.0, 0.0, 0.0]) for i in range(3000, 4500)]  # one direction, one key
    monkeypatch.setattr(ann, "BUNDLE_ROWS", 16)
    sizes, bundled = [], ann.bundled

    def watched(placed, most):
        found = bundled(placed, most)
        sizes.extend(r["n"] for r in found.select(F.size("bundle").alias("n")).collect())
        return found

    monkeypatch.setattr(ann, "bundled", watched)
    got = searched(spark, rows, folder(), window=2.0, k=3)
    assert max(sizes) <= 16 and sum(sizes) == ann.CURVES * (3 + 1 + 90)
    numbers, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    assert got.keys() == {i for i, _ in rows if i % 100 == 0}
    for i, vector in rows[::50]:
        if i in got:
            far = np.sqrt(((vectors - vector) ** 2).sum(axis=1))
            near = [j for j in numbers[np.lexsort((numbers, far))].tolist() if j != i]
            assert [j for j, _ in got[i]] == near[:3]
    many = spark.createDataFrame(  # queries of one rank
        [(0, i, True, 0, 0, i, [1.0]) for i in range(1000)],
        "curve int, vec_id long, query boolean, rank long, part int, asked long, vector array<double>",
    )
    assert bundled(many, 16).select(F.max(F.size("bundle"))).first()[0] == 16
