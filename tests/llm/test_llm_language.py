import numpy as np
from pyspark.sql import functions as F

from tickweave.llm import crf, language
from tickweave.llm.queries import id_remainder


def test_held_out_accuracy(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.with_language(frame, id_remainder(4) == 2)
    held = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.98


def test_code_switched_lines_are_told_apart(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(language.passages(frame, F.lit(True)))
    by_lang = {r["lang"]: r["text"] for r in frame.filter("n_chars > 2000").collect()}
    english = " ".join(by_lang["en"].split()[:30])
    german = " ".join(by_lang["de"].split()[:30])
    text = np.frombuffer(f"{english} {german}".encode(), np.uint8)
    words = crf.find_words(text, np.array([0, len(text)]))
    buckets, first = crf.hashed_features(words, np.arange(len(words)))
    emissions = model.emissions(buckets, first, model.listed(words.hashes()))
    posterior, _ = crf.marginals(emissions, np.array([0]), np.array([len(words)]), model.transitions)
    seen = [model.labels[i] for i in posterior.argmax(axis=1)]
    middle = len(crf.find_words(np.frombuffer(english.encode(), np.uint8), np.array([0, len(english.encode())])))
    assert np.mean([s == "en" for s in seen[:middle]]) > 0.9 and np.mean([s == "de" for s in seen[middle:]]) > 0.9


def test_marginals_match_enumeration():
    random = np.random.default_rng(1)
    emissions, transitions = random.normal(size=(5, 3)), random.normal(size=(3, 3))
    got, moves = crf.marginals(emissions, np.array([0, 4]), np.array([4, 1]), transitions)
    weight, wanted, pairs = 0.0, np.zeros((4, 3)), np.zeros((3, 3))
    for path in np.ndindex(3, 3, 3, 3):
        score = sum(emissions[i, label] for i, label in enumerate(path))
        score = np.exp(score + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        weight += score
        for i, label in enumerate(path):
            wanted[i, label] += score
        for a, b in zip(path, path[1:]):
            pairs[a, b] += score
    assert np.allclose(got[:4], wanted / weight) and np.allclose(moves, pairs / weight)
    assert np.allclose(got[4], np.exp(emissions[4]) / np.exp(emissions[4]).sum())


def test_odd_documents(odd_documents, no_documents):
    got = language.identify(odd_documents, id_remainder(4) == 2).collect()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert len(got) == odd_documents.count()
    for doc_id in (1, 2, 3, 9):
        assert by_id[doc_id]["lang_pred"] == "und" and by_id[doc_id]["score"] == 0
    for doc_id in (4, 5, 6, 8, 10):
        assert by_id[doc_id]["lang_pred"] in ("de", "en", "fr") and 0 < by_id[doc_id]["score"] <= 1
    assert language.identify(no_documents, F.lit(False)).count() == 0
    unlabelled = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled, F.lit(False)).collect()} == {"und"}
    kept = language.with_language(odd_documents, F.lit(False))
    assert set(kept.columns) == set(odd_documents.columns) | {"held_out", "lang_pred", "score"}
