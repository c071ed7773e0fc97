import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tickweave.llm import middle

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")


def expected(doc_id, text):
    """(n, form, prefix characters, middle characters, output) by plain slicing."""
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return n, "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


def compared(frame):
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    got = middle.restored(middle.rearranged(frame)).collect()
    own = sorted(((i, *expected(i, t), t or "") for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == own
    return got


def test_documents_match_plain_slicing(spark):
    got = compared(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    forms = [r["form"] for r in got]
    assert {"plain", "psm", "spm"} == set(forms) and forms.count("psm") > forms.count("spm")


def test_odd_documents(odd_documents, no_documents):
    assert len(compared(odd_documents)) == odd_documents.count()
    assert middle.restored(middle.rearranged(no_documents)).count() == 0


def test_sentinels_and_characters(spark):
    source = random.Random(4)
    pieces = ["<", ">", "P", "<P", "P>", "<S", "M>", "<M", "<P>", "é", "日本", "🙂", "word", " ", "\n", "\x00"]
    rows = [(i, "".join(source.choices(pieces, k=source.randrange(14)))) for i in range(600)]
    got = compared(spark.createDataFrame(rows, "doc_id long, text string"))
    assert any(r["form"] == "plain" and "<P>" in r["output"] for r in got)


@given(st.text("<>PSM aé", max_size=20), st.data(), st.sampled_from(["psm", "spm"]))
@settings(max_examples=300, deadline=None)
def test_every_cut_comes_back(text, data, form):
    if any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return
    raw = text.encode()
    first, second = sorted(data.draw(st.tuples(*[st.integers(0, len(raw))] * 2)))
    prefix, mid, suffix = raw[:first], raw[first:second], raw[second:]
    out = bytes(middle.arrange(raw, first, second, form))
    blocks = [b"<P>" + prefix, b"<M>" + mid, b"<S>" + suffix]
    assert out == b"".join([blocks[0], blocks[2], blocks[1]] if form == "psm" else [blocks[2], *blocks[:2]])
    assert middle.rebuild(out, form) == raw


@given(st.binary(max_size=60), st.data())
@settings(max_examples=200, deadline=None)
def test_rotation_exchanges_blocks(raw, data):
    a, b, c = sorted(data.draw(st.tuples(*[st.integers(0, len(raw))] * 3)))
    buffer = bytearray(raw)
    middle.rotate(buffer, a, b, c)
    assert bytes(buffer) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]
    middle.rotate(buffer, a, a + c - b, c)
    assert bytes(buffer) == raw
