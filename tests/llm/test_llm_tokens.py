import heapq
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickweave.llm import hilbert, huffman, packing, token_files, tokens
from tickweave.llm.queries import tokenizer_file

WORD, BYTE = ("word_bpe_49k.json", "word", 49_408, 2), ("byte_bpe_50k.json", "spaced", 50_257, 0)


def plain(name):
    tokenizer = Tokenizer.from_file(tokenizer_file(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


texts = st.lists(
    st.one_of(
        st.none(),
        st.text(st.sampled_from(list("aAé×'s.t1 \n\t 　—“ñ<|\x1ć")), max_size=25),
        st.text(max_size=12),
    ),
    min_size=1,
    max_size=8,
)


@pytest.mark.parametrize("name,cut,_,end", [WORD, BYTE])
def test_pieces_encode_like_whole_texts(name, cut, _, end):
    encode, coder = plain(name), tokens.Coder(tokenizer_file(name), cut)

    @settings(max_examples=200, deadline=None)
    @given(texts)
    def same(found):
        ids, bounds = coder.ids(pa.array(found, pa.string()), end)
        for text, a, b in zip(found, bounds, bounds[1:]):
            assert ids[a:b].tolist() == [*encode(text), end]

    same()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=700), st.integers(0, 700))
def test_coded_blocks_come_back(ids, cut):
    ids = np.array(ids, dtype=np.uint32)
    book = huffman.Codebook(huffman.code_lengths(np.bincount(ids, minlength=41), limit=6))
    parts = [ids[:cut], ids[cut:]]
    coded = [book.encode(p) for p in parts]
    sizes = np.array([len(p) for p in parts])
    assert (book.decode([c[0] for c in coded], [c[1] for c in coded], sizes) == ids).all()


def test_code_lengths_are_limited_and_best():
    counts = np.array([0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    free, short = huffman.code_lengths(counts, 30), huffman.code_lengths(counts, 4)
    assert free[0] == short[0] == 0 and free.max() == 9 and short.max() == 4
    for lengths in (free, short):
        assert sum(2.0 ** -int(n) for n in lengths if n) == 1
    heap, inner = sorted(int(c) for c in counts if c), 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        heapq.heappush(heap, both)
        inner += both
    assert int((free * counts).sum()) == inner  # the bits of a plain Huffman code
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(20), 4)


@pytest.mark.parametrize("limit", [16, 17, 18, 20, 24, 28])
def test_long_codes_come_back(limit):
    """Counts that grow like Fibonacci numbers have codes as long as the limit allows."""
    counts = np.ones(limit + 3, dtype=np.int64)
    for i in range(2, len(counts)):
        counts[i] = counts[i - 1] + counts[i - 2]
    book = huffman.Codebook(huffman.code_lengths(counts, limit))
    assert book.bits == limit
    source = np.random.default_rng(limit)
    blocks = [source.integers(0, len(counts), n).astype(np.uint32) for n in (1, 700, 0, 257)]
    coded = [book.encode(ids) for ids in blocks]
    back = book.decode([c[0] for c in coded], [c[1] for c in coded], np.array([len(b) for b in blocks]))
    assert (back == np.concatenate(blocks)).all()


def test_vocabularies_beyond_the_limit_take_longer_codes():
    counts = np.ones(70_000, dtype=np.int64)
    assert huffman.least_limit(counts) == 17 and huffman.least_limit(counts[: 1 << 16]) == 16
    book = huffman.Codebook(huffman.code_lengths(counts, huffman.least_limit(counts)))
    ids = np.arange(70_000, dtype=np.uint32)[::-1].copy()
    bits, marks = book.encode(ids)
    assert (book.decode([bits], [marks], np.array([len(ids)])) == ids).all()
    assert huffman.least_limit(np.zeros(5)) == huffman.LIMIT
    with pytest.raises(ValueError):
        huffman.Codebook(np.array([29, 29]))


def round_trip(spark, frame, folder, **settings):
    name, cut, vocabulary, end = WORD
    token_files.write(
        frame, f"{folder}/corpus", f"{folder}/work", tokenizer_file(name), vocabulary, cut, end, **settings
    )
    return token_files.read(spark, f"{folder}/corpus")


def test_token_files_round_trip(spark, folder):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy(F.xxhash64("doc_id"))
    got = round_trip(spark, frame, folder(), partition_bytes=50_000, block_ids=3_000)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in got.collect())
    encode, at, want = plain(WORD[0]), 0, []
    for doc_id, text in sorted((r["doc_id"], r["text"]) for r in frame.collect()):
        ids = [*encode(text), WORD[3]]
        want.append((doc_id, at, len(ids), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want
    assert spark.read.parquet(f"{folder()}/corpus/blocks").count() > 8


def test_token_files_of_odd_documents(spark, odd_documents, no_documents, folder):
    got = round_trip(spark, odd_documents, folder("a")).orderBy("start").collect()
    encode = plain(WORD[0])
    want = sorted(
        ((r["doc_id"] is not None, r["doc_id"] or 0), len(encode(r["text"])) + 1) for r in odd_documents.collect()
    )
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got] == [w[0] for w in want]
    assert sorted(r["n_tokens"] for r in got) == sorted(w[1] for w in want)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    assert round_trip(spark, no_documents, folder("b")).count() == 0


def packed(frame, folder):
    name, cut, vocabulary, end = BYTE
    return packing.pack(frame, folder, tokenizer_file(name), vocabulary, cut, end, length=1024)


def check_pieces(got, want):
    """Every id in one piece; sequences gapless, full or of a power of two."""
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, ids in want.items():
        pieces = sorted(by_doc.pop(doc_id))
        assert b"".join(p[2] for p in pieces) == np.array(ids, "<u4").tobytes()
        assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1]]
        assert {p[3] for p in pieces} == {len(ids)}
    assert not by_doc
    sizes = []
    for _, pieces in sorted(by_sequence.items()):
        pieces.sort()
        assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1]]
        sizes.append(sum(p[1] for p in pieces))
    full = sizes.count(1024)
    assert all(s == 1024 for s in sizes[:full]) and all(s & (s - 1) == 0 for s in sizes)


def test_packing_holds_every_id_once(spark, folder):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    encode = plain(BYTE[0])
    want = {r["doc_id"]: [*encode(r["text"]), BYTE[3]] for r in frame.collect()}
    got = packed(frame, folder()).collect()
    check_pieces(got, want)
    languages = {r["doc_id"]: r["lang"] for r in frame.collect()}
    neighbours = {}
    for r in got:
        neighbours.setdefault(r["sequence_id"], set()).add(languages[r["doc_id"]])
    assert np.mean([len(n) for n in neighbours.values()]) < 1.6  # like documents share sequences


def test_packing_of_odd_documents(odd_documents, no_documents, folder):
    encode = plain(BYTE[0])
    frame = odd_documents.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    want = {r["doc_id"]: [*encode(r["text"]), BYTE[3]] for r in frame.collect()}
    check_pieces(packed(frame, folder("a")).collect(), want)
    every = packed(odd_documents, folder("b")).agg(F.sum("length")).first()[0]
    assert every == sum(len(encode(r["text"])) + 1 for r in odd_documents.collect())
    assert packed(no_documents, folder("c")).count() == 0


def test_hilbert_neighbours_are_adjacent():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        keys = hilbert.keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_crc_of_pieces_is_that_of_the_ids(spark):
    ids = np.array([1, 70_000, 3], "<u4").tobytes()
    got = spark.createDataFrame([(bytearray(ids),)], "ids binary").select(F.crc32("ids")).first()[0]
    assert got == zlib.crc32(ids)
