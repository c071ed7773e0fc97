import random

import llm_brute as brute
import numpy as np
import pytest
import xxhash

from tickweave.llm import simhash
from tickweave.llm.queries import QUERIES


def fingerprint(text, size=4):
    own = brute.words(text)
    shingles = [" ".join(own[i : i + size]) for i in range(max(len(own) - size + 1, 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, bits):
    """Component of each place of a list of fingerprints: the smallest place that is reachable."""
    prints = np.array(prints, dtype=np.uint64)
    label = np.full(len(prints), -1)
    for first in range(len(prints)):
        if label[first] < 0:
            queue = [first]
            label[first] = first
            while queue:
                at = queue.pop()
                near = (np.bitwise_count(prints ^ prints[at]) <= bits) & (label < 0)
                label[near] = first
                queue.extend(np.flatnonzero(near).tolist())
    return label


def expected(rows, bits=4):
    rows = sorted(rows)
    prints = [fingerprint(text) for _, text in rows]
    label = linked(prints, bits)
    return {i: (p, rows[c][0]) for (i, _), p, c in zip(rows, prints, label)}


def found(frame, folder, **settings):
    got = simhash.near_duplicates(frame, folder, **settings).collect()
    return {r["doc_id"]: (r["fingerprint"] % (1 << 64), r["component_id"]) for r in got}


def test_documents_match_all_pairs(spark, folder):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = expected([tuple(r) for r in frame.collect()])
    assert found(frame, folder()) == want
    assert any(component != doc_id for doc_id, (_, component) in want.items())
    got = QUERIES["op13_simhash"](spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in got} == want
    assert all(len(r["fingerprint"]) == 16 for r in got)


def flipped(source, value, bits):
    for b in source.sample(range(64), bits):
        value ^= 1 << b
    return value


def planted(source, groups, steps):
    """Chains and stars of fingerprints at one to six bits."""
    prints = []
    for _ in range(groups):
        at = [source.getrandbits(64)]
        for _ in range(steps):
            at.append(flipped(source, source.choice(at[-3:]), source.randrange(1, 7)))
        prints += at
    return sorted(set(prints))


@pytest.mark.parametrize("bits", [0, 2, 4])
@pytest.mark.parametrize("limit", [simhash.GROUP_LIMIT, 2])
def test_links_join_what_all_pairs_join(spark, folder, bits, limit):
    """Small groups in tasks, and with a limit of two the words near each fingerprint."""
    prints = planted(random.Random(bits), 40 if limit > 2 else 12, 12)
    signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    frame = spark.createDataFrame(signed, "print long")
    got = simhash.links(frame, folder(), bits, limit).collect()
    place = {p: i for i, (p,) in enumerate(signed)}
    root = list(range(len(prints)))

    def top(node):
        while root[node] != node:
            node = root[node]
        return node

    for a, b in got:
        differ = int(a ^ b).bit_count() if a ^ b >= 0 else ((a ^ b) % (1 << 64)).bit_count()
        assert 0 < differ <= bits
        one, two = top(place[a]), top(place[b])
        root[max(one, two)] = min(one, two)
    assert [top(i) for i in range(len(prints))] == linked(prints, bits).tolist()


def test_near_halves_share_an_anchor():
    source = random.Random(1)
    for _ in range(300):
        one = source.getrandbits(32)
        two = one
        for b in source.sample(range(32), source.randrange(0, 3)):
            two ^= 1 << b
        near = [set(simhash.anchors_near(np.array([h], np.uint32))[0].tolist()) for h in (one, two)]
        assert near[0] & near[1]
        assert len(near[0]) in (2, 17)
        assert all(int(one ^ a).bit_count() <= 2 for a in near[0])


def test_a_forest_joins_and_holds_no_pairs():
    dense = np.array([0] + [1 << i for i in range(64)], dtype=np.uint64)
    a, b = simhash.forest(dense, 4)
    assert len(a) == len(dense) - 1
    assert len(simhash.forest(np.zeros(0, np.uint64), 4)[0]) == 0


def test_large_cluster_of_near_copies(spark, folder):
    """One text edited in many places, through both ways of comparing."""
    source = random.Random(3)
    base = [f"w{source.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(400):
        own = list(base)
        own[source.randrange(120)] = f"v{source.randrange(50)}"
        rows.append((i + 1, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = expected(rows)
    assert found(frame, folder("tasks")) == want
    assert found(frame, folder("words"), group_limit=20) == want
    assert len({c for _, c in want.values()}) < 300


def test_replicated_rows_are_not_broadcast(spark, folder, monkeypatch):
    """Their size is unknown to the planner, which takes them for as few as went in."""
    base, joined = random.Random(4).getrandbits(62), []
    prints = sorted({base ^ (1 << i) ^ (1 << j) for i in range(9) for j in range(9)})
    rows = spark.createDataFrame([(i, f"t{p}") for i, p in enumerate(prints)], "doc_id long, text string")
    join = type(rows).join

    def recorded(left, right, on=None, how=None):
        out = join(left, right, on, how)
        joined.append((on, out))
        return out

    monkeypatch.setattr(type(rows), "join", recorded)
    signed = spark.createDataFrame([(p,) for p in prints], "print long")
    simhash.links(signed, folder("links"), 4, 8).collect()
    simhash.near_duplicates(rows, folder("all")).collect()
    assert {on for on, _ in joined} >= {"anchor", "word", "a", "b"}
    for on, frame in joined:
        if on in ("anchor", "word", "a", "b"):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in next(line for line in plan.splitlines() if "Join" in line), on


def test_odd_documents(odd_documents, no_documents, folder):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    got = simhash.near_duplicates(odd_documents, folder("a")).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] or 0, r["fingerprint"] % (1 << 64)) for r in got) == sorted(
        (i or 0, fingerprint(t)) for i, t in rows
    )
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    with_id = {i: t for i, t in rows if i is not None}
    want = expected(list(with_id.items()))
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"]} == {i: c for i, (_, c) in want.items()}
    assert simhash.near_duplicates(no_documents, folder("b")).count() == 0


def test_rows_of_one_id_join_their_groups(spark, folder):
    one, two = "a b c d e f g h", "q r s t u v w x"
    frame = spark.createDataFrame([(5, one), (5, two), (3, one), (9, two)], "doc_id long, text string")
    got = simhash.near_duplicates(frame, folder()).collect()
    assert {r["component_id"] for r in got} == {3}
