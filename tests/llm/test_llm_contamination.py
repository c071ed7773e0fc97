import llm_brute as brute
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
import pyarrow as pa

from tickweave.llm import decontaminate as d


def searched(rows, items, window):
    batch = pa.record_batch(
        {
            "row": pa.array([{"doc_id": i} for i, _ in rows], pa.struct([("doc_id", pa.int64())])),
            "text": pa.array([t for _, t in rows], pa.string()),
            "marks": pa.nulls(len(rows), pa.binary()),
            "items": pa.array([[] for _ in rows], pa.list_(pa.string())),
        }
    )
    for block in items:
        batch = d._mark(batch, d.patterns([(None if i is None else str(i), t) for i, t in block], window))
    found = d._summary(batch).to_pylist()
    return [(r["row"]["doc_id"], *(r[c] for c in d.FOUND)) for r in found]


words = st.lists(st.sampled_from("abcd"), max_size=30).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(words, max_size=5), st.lists(words, max_size=6), st.integers(1, 5), st.booleans())
def test_search_finds_what_a_plain_scan_finds(texts, items, window, in_blocks):
    rows, items = list(enumerate(texts)), list(enumerate(items))
    blocks = [[x] for x in items] if in_blocks else [items]
    assert searched(rows, blocks, window) == brute.contamination(rows, items, window)


def test_long_texts_are_searched_to_the_end():
    passage = "one two three four five six seven eight nine ten"
    noise = " ".join(f"n{i}" for i in range(5000))
    got = searched([(1, f"{noise} {passage} {noise}"), (2, noise)], [[(7, passage)]], 10)
    assert [r[2] for r in got] == [10, 0]


def test_odd_documents(spark, odd_documents, no_documents):
    items = [(1, "twice over and over again. and a second line of it"), (2, None), (None, "few words"), (3, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = d.contamination(odd_documents, benchmark).collect()
    want = brute.contamination([(r["doc_id"], r["text"]) for r in odd_documents.collect()], items)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r["contaminated"] for r in got) == 4
    assert d.contamination(no_documents, benchmark).count() == 0
    empty = d.contamination(odd_documents, benchmark.limit(0)).collect()
    assert len(empty) == len(got) and not any(r["contaminated"] for r in empty)
    kept = d.with_contamination(odd_documents, benchmark)
    assert set(kept.columns) == set(odd_documents.columns) | set(d.FOUND) and kept.count() == len(got)


def test_shift_tables_never_skip_a_pattern():
    tables = d.patterns([("1", "a b c d e"), ("2", "c d e f g")], 5)
    assert len(tables) == 1 and tables[0].shift.min() == 0 and tables[0].shift.max() == 4
    assert np.all(np.diff(tables[0].bucket) >= 0)


def test_large_benchmarks_stay_in_the_tasks(spark, odd_documents, no_documents, monkeypatch):
    def no_tables(*_):
        raise AssertionError("tables of a large benchmark")

    monkeypatch.setattr(d, "patterns", no_tables)
    items = [(1, "twice over and over again. and a second line of it"), (2, None), (None, "few words"), (3, "")]
    items += [(4, "few words"), (10, "words"), (11, "word1x1 word2x2 word3x3 " * 4), (1, "same text here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = d.contamination(odd_documents, benchmark, block_bytes=1).collect()
    want = brute.contamination([(r["doc_id"], r["text"]) for r in odd_documents.collect()], items)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r["contaminated"] for r in got) == 4
    assert d.contamination(no_documents, benchmark, block_bytes=1).count() == 0


def test_join_finds_what_a_plain_scan_finds(spark):
    draw = np.random.default_rng(4)
    texts = [" ".join(draw.choice(list("abc"), draw.integers(0, 60))) for _ in range(60)]
    rows, items = list(enumerate(texts[:40])), [(i, t) for i, t in enumerate(texts[40:])]
    frames = [spark.createDataFrame(x, f"{c} long, text string") for x, c in ((rows, "doc_id"), (items, "item_id"))]
    for window in (3, 10):
        got = d.contamination(*frames, window=window, block_bytes=1).collect()
        assert sorted(map(tuple, got)) == sorted(brute.contamination(rows, items, window))


def test_tables_are_sized_by_distinct_blocks():
    text = " ".join(f"w{i}" for i in range(20_000))
    (table,) = d.patterns([("1", text)], 10)
    assert len(table.windows) == 19_991 and table.shift.nbytes + table.bucket.nbytes < 2 << 20
