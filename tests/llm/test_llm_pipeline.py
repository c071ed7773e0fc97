import llm_brute as brute
import pytest

import corpus_pipeline as pipeline
from tickweave.llm import line_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage over the smallest tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def ids(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_stages_keep_the_columns_of_documents(stages):
    for name, (docs, result) in list(stages.items())[:-1]:
        assert result.columns == docs.columns, name
        assert result.dtypes == docs.dtypes, name


def test_language_keeps_clean_documents(stages):
    docs, result = stages["language_id"]
    lettered = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert len(lettered - ids(result)) <= 0.01 * len(lettered) and ids(result) <= lettered


def test_lines_keep_every_document_that_keeps_words(stages, spark, tmp_path):
    docs, result = stages["line_dedup"]
    cleaned = line_dedup.drop_recurring(docs, str(tmp_path / "lines"), pairs=True).collect()
    emptied = {r["doc_id"] for r in cleaned if r["n_dropped"] and not brute.words(r["text"])}
    assert ids(docs) == ids(result) | emptied and not ids(result) & emptied
    before = sum(len(r["text"]) for r in docs.collect())
    after = [r for r in result.collect()]
    assert 0 < sum(len(r["text"]) for r in after) < before
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_one_document_of_each_group_stays(stages):
    docs, result = stages["jaccard_join"]
    groups = brute.near_duplicates([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)
    assert ids(result) == {component for _, component in groups.values()}


def test_contaminated_documents_go(stages, spark):
    docs, result = stages["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = brute.contamination([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert ids(result) == {r[0] for r in found if not r[-1]}


def test_packing_takes_all_that_is_left(stages):
    docs, result = stages["packing"]
    assert ids(docs) == ids(result)


def test_odd_documents_pass_through(spark, odd_documents, tmp_path):
    docs = odd_documents.withColumn("source", odd_documents["row"]).selectExpr("*", "0L AS n_chars")
    for name, stage in pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        result = spark.read.parquet(path)
        if name != "packing":
            assert result.columns == docs.columns
        docs = result
    assert {4, 6, 8, 10, None} <= ids(docs) and not ids(docs) & {1, 2, 3, 5, 7, 9}


def test_lines_that_two_documents_share_go_and_copies_are_left_to_the_join(spark):
    shared = "a passage that exactly two documents share word for word"
    rows = [(1, shared, 0), (2, f"other words here\n{shared}", 0), (4, "", 0), (5, "a text of its own", 0), (6, "A text of its own", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in pipeline.dedup_lines(spark, docs, SF).collect()}
    assert got == {1: shared, 2: "other words here", 4: "", 5: rows[3][1], 6: rows[4][1]}


def test_emptied_copies_go_and_their_lines_stay_once(spark):
    line = "a line that many documents hold word for word"
    rows = [(i, line, 0) for i in range(1, 5)] + [(9, f"{line}\nand words of its own here", 0), (10, " ", 0), (11, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in pipeline.dedup_lines(spark, docs, SF).collect()}
    assert got == {1: line, 9: "and words of its own here", 10: " ", 11: None}


def test_texts_of_no_clear_language_go_and_code_switched_ones_stay(spark):
    import random

    source = random.Random(6)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = {}
    for r in docs.select("lang", "text").collect():
        words.setdefault(r["lang"], []).extend(brute.words(r["text"])[:200])
    langs = sorted(words)
    salad = " ".join(source.choice(words[source.choice(langs)]) for _ in range(400))
    switched = "\n".join(" ".join(source.sample(words[lang], 60)) for lang in (langs[0], langs[1]) * 3)
    plain = " ".join(source.sample(words[langs[2]], 200))
    rows = [(10**6, salad), (10**6 + 1, switched), (10**6 + 2, plain), (10**6 + 3, "12 34 !!")]
    extra = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) AS lang", "'s' AS source", "0L AS n_chars"
    )
    kept = pipeline.identify_language(spark, docs.unionByName(extra), SF)
    found = {r["doc_id"]: r["lang"] for r in kept.filter("doc_id >= 1000000").collect()}
    assert found.keys() == {10**6 + 1, 10**6 + 2} and found[10**6 + 2] == langs[2]
    assert kept.count() >= 0.999 * docs.count()


def test_the_least_score_follows_the_number_of_languages():
    scores = [pipeline.least_language_score(n) for n in (1, 2, 3, 4, 10, 100)]
    assert scores[0] == 1 and scores[1] == 0.5 and scores[2:] == sorted(scores[2:], reverse=True)
    assert all(1 / n <= s for n, s in zip((1, 2, 3, 4, 10, 100), scores)) and max(scores[2:]) <= 0.5


def test_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = str(tmp_path / "sf")
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").limit(0).write.parquet(f"{empty}/benchmark.parquet")
    assert pipeline.run(spark, empty).count() == 0
    some = docs.limit(20)
    kept = pipeline.drop_contaminated(spark, some, empty)
    assert ids(kept) == ids(some)
