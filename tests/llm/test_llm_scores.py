import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import lm
from tickweave.llm.queries import QUERIES, id_remainder


def compared(got, want):
    key = repr
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_match_a_direct_computation(spark, order):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = lm.score(frame, id_remainder(7) == 2, order=order, chunk_bytes=40_000).collect()
    compared(got, brute.lm_scores([tuple(r) for r in frame.collect()], order))
    held = [r for r in got if r["held_out"]]
    better = sum(r["score"] for r in held) - sum(r["base_score"] for r in held)
    assert held and (better > 0 if order > 1 else better == pytest.approx(0))


def test_the_query_scores_with_trigrams(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    compared(QUERIES["op2_lm_score"](spark, "/root/testdata/sf0.01").collect(), brute.lm_scores(rows, 3))


def test_longer_histories_only_help_copies(spark):
    rows = [(i, f"a b c d e f {i} g") for i in range(1, 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    two = lm.score(frame, F.lit(False), order=2).agg(F.sum("score")).first()[0]
    four = lm.score(frame, F.lit(False), order=4).agg(F.sum("score")).first()[0]
    assert four > two


def test_a_state_is_normalised(spark):
    """One-word texts: chances of all known words, the end and an unknown word after the start sum to 1."""
    train = [(1, "a b a"), (3, "b c"), (4, "a")]
    probes = [(100 + i, w) for i, w in enumerate(["a", "b", "c", "", "zzz"])]
    frame = spark.createDataFrame([*train, *probes], "doc_id long, text string")
    got = lm.score(frame, F.col("doc_id") >= 100, order=2).filter("doc_id >= 100").collect()
    by_id = {r["doc_id"]: r for r in got}
    end_after = {}
    for word, seen, followed in (("a", 3, 2), ("b", 2, 0), ("c", 1, 1)):
        root_end = (3 + 1) / (9 + 4 + 1)
        weight = 2.0 * seen**0.9
        end_after[word] = (followed + weight * root_end) / (seen + weight)
    end_after["zzz"] = (3 + 1) / (9 + 4 + 1)
    total = 10 ** by_id[103]["score"]
    for doc_id, word in probes:
        if word:
            total += 10 ** by_id[doc_id]["score"] / end_after[word]
    assert total == pytest.approx(1.0)


@pytest.mark.parametrize("order", [2, 3])
def test_odd_documents(odd_documents, no_documents, order):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    got = lm.score(odd_documents, id_remainder(7) == 2, order=order).collect()
    compared(got, brute.lm_scores(rows, order))
    assert lm.score(no_documents, id_remainder(7) == 2, order=order).count() == 0


def test_nothing_to_train_on(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = lm.score(frame, F.lit(True)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in got) == [(1, 0, 0, 0), (3, 0, 0, 0)]


def test_packed_numbers_come_back():
    values = np.array([0, 1, 255, 256, 1 << 40, (1 << 56) - 1], dtype=np.uint64)
    assert lm.unsqueezed(lm.squeezed(values)).tolist() == values.tolist()
    assert len(lm.unsqueezed(lm.squeezed(values[:0]))) == 0


def test_requests_hold_no_places():
    """The n-grams of a request and their counts are those of the walk, without an array of where they stand."""
    import numpy as np
    import pyarrow as pa

    texts = ["a b a b c", None, "", "c b a", "a b a b c", "x"]
    batch = pa.record_batch(
        {
            "doc_id": pa.array(range(len(texts)), pa.int64()),
            "held_out": pa.array([False, False, True, True, False, False]),
            "text": pa.array(texts, pa.string()),
        }
    )
    for rows in (batch, batch.slice(0, 0)):
        whole, counted = lm.Grams(rows, 3), lm.Grams(rows, 3, places=False)
        assert not counted.which and not counted.first
        for one, other in zip(whole.keys + whole.counts, counted.keys + counted.counts, strict=True):
            assert one.dtype == other.dtype and np.array_equal(one, other)
