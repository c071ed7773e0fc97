import random

import llm_brute as brute
import pytest
from pyspark.sql import functions as F

from tickweave.llm import components, jaccard


def found(frame, folder, **settings):
    got = jaccard.near_duplicates(frame, folder, **settings).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_components_match_all_pairs(spark, folder, size, percent):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in frame.collect()]
    got = found(frame, folder(), shingle_words=size, percent=percent)
    assert got == brute.near_duplicates(rows, size, percent)


@pytest.mark.parametrize("size,percent", [(3, 90), (2, 80)])
def test_edited_copies_of_all_sizes(spark, folder, size, percent):
    """Chains of edited copies near the threshold, where stars alone would not do."""
    source = random.Random(11)
    rows = []
    for words in (3, 8, 12, 20, 33, 60, 150, 400):
        base = [f"w{source.randrange(2000)}" for _ in range(words)]
        for _ in range(9):
            rows.append((len(rows) + 1, " ".join(base)))
            for _ in range(max(words // 60, 1)):
                base = list(base)
                base[source.randrange(len(base))] = f"v{source.randrange(2000)}"
    source.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame, folder(), shingle_words=size, percent=percent) == brute.near_duplicates(rows, size, percent)


def test_common_passage_does_not_link(spark, folder):
    source = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"x{source.randrange(10**6)}" for _ in range(50))) for i in range(1, 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(frame, folder(), shingle_words=3, percent=90)
    assert all(got[i][1] == i for i, _ in rows)


def test_odd_documents(odd_documents, no_documents, folder):
    got = jaccard.near_duplicates(odd_documents, folder("a"), shingle_words=3, percent=90).collect()
    assert len(got) == odd_documents.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert by_id[1]["n_shingles"] == 0 and by_id[1]["component_id"] == 1
    assert by_id[5]["component_id"] == 4 and by_id[7]["component_id"] == 6
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    assert jaccard.near_duplicates(no_documents, folder("b")).count() == 0


def test_rows_of_one_id_join_their_groups(spark, folder):
    one, two = "a b c d e f g h", "q r s t u v w x"
    rows = [(5, one), (5, two), (3, one), (9, two)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicates(frame, folder(), shingle_words=3, percent=90).collect()
    assert {r["component_id"] for r in got} == {3}


def test_components_of_paths_and_stars(spark, folder):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(frame, folder("a")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}}
    assert components.components(frame.filter(F.lit(False)), folder("b")).count() == 0
