import random
import re
from collections import Counter, defaultdict

import llm_brute as brute
import numpy as np
import pytest

from tickweave.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def expected(rows, min_docs=30, top=50):
    """All result rows for (lang, source, text) rows."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        own = TERM.findall(brute.lower(text))
        counts[lang or "", source or ""].update(own)
        docs[lang or ""].update(set(own))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for known, s in counts if known == lang]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        q = shares(whole)
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            ahead = [
                (q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]
            ]
            for part, found, most in (("pair", pairs, None), ("term", ahead, top)):
                for rank, (value, _, item) in enumerate(sorted(found)[:most], 1):
                    out.append((lang, s, part, item, -value, rank))
    return sorted(out)


def compared(frame, folder, **settings):
    rows = [(r["lang"], r["source"], r["text"]) for r in frame.collect()]
    got = divergence.divergence(frame, folder, **settings)
    names = ["lang", "source", "part", "item", "value", "rank"]
    assert got.columns == names
    own = sorted(tuple(r[n] for n in names) for r in got.collect())
    want = expected(rows, settings.get("min_docs", 30), settings.get("terms", 50))
    assert own == want
    return own


def test_documents_match_a_direct_count(spark, folder):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own = compared(frame, folder(), min_docs=3)
    assert {r[2] for r in own} == {"pair", "term"} and any(r[5] == 50 for r in own)


@pytest.mark.parametrize("digest_bits", [1, 7, 11])
def test_shared_digests_are_split(spark, folder, digest_bits):
    """With so few bits nearly all digests stand for several terms."""
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    compared(frame, folder(), min_docs=4, terms=20, digest_bits=digest_bits)


def test_many_sources_ties_and_languages_without_terms(spark, folder, monkeypatch):
    source = random.Random(5)
    rows = [
        ("aa", f"s{source.randrange(40)}", " ".join(f"É{chr(97 + source.randrange(26))}" for _ in range(6)))
        for _ in range(400)
    ]
    rows += [("bb", f"s{i}", f"only here {i}") for i in range(4)] + [("bb", "s0", None), (None, None, "x y z")]
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    monkeypatch.setattr(divergence, "SUMS", 1000)
    monkeypatch.setattr(divergence, "BUNDLE_TERMS", 4)
    own = compared(frame, folder(), min_docs=5, terms=3)
    assert all(r[4] == 0 for r in own if r[0] == "bb")


def test_odd_documents(odd_documents, no_documents, folder):
    frame = odd_documents.selectExpr("*", "score AS source")
    compared(frame, folder("a"), min_docs=2)
    compared(frame, folder("b"), min_docs=1)
    empty = no_documents.selectExpr("*", "score AS source")
    assert divergence.divergence(empty, folder("c")).count() == 0


def test_shares_are_exact(spark):
    source = random.Random(8)
    counts = [source.randrange(10 ** source.randrange(1, 16)) for _ in range(300)]
    totals = [c + 5 + source.randrange(10**15) for c in counts]
    want = [1 + 10**9 * (c + 5) // t for c, t in zip(counts, totals)]
    assert divergence.share(np.array(counts), np.array(totals)).tolist() == want
    frame = spark.createDataFrame(list(zip(range(300), counts, totals)), "i int, c long, t long")
    got = frame.select("i", divergence._share(frame["c"], frame["t"]).alias("p")).orderBy("i").collect()
    assert [r["p"] for r in got] == want
