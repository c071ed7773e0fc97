"""Plain restatements of the operators' results for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def remainder(doc_id, modulus):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def lm_scores(rows, order=2, strength=2.0, growth=0.9):
    """op2 for (doc_id, text) rows, each chance by recursion; ``"\\n"`` is the end and ``"\\t"`` the start."""
    tokens = [[*words(text), "\n"] for _, text in rows]
    held = [remainder(doc_id, 7) == 2 for doc_id, _ in rows]
    seen, followed, single = Counter(), Counter(), Counter()
    for own, out in zip(tokens, held):
        if out:
            continue
        single.update(own)
        marked = ["\t", *own]
        for i in range(1, len(marked)):
            for n in range(1, min(order - 1, i) + 1):
                seen[tuple(marked[i - n : i + 1])] += 1
                followed[tuple(marked[i - n : i])] += 1
    n, v = sum(single.values()), len(single)

    def chance(history, word):
        if not history:
            return (single[word] + 1) / (n + v + 1)
        count = followed[history]
        if not count:
            return chance(history[1:], word)
        weight = strength * count**growth
        return (seen[(*history, word)] + weight * chance(history[1:], word)) / (count + weight)

    result = []
    for (doc_id, _), own, out in zip(rows, tokens, held):
        marked = ["\t", *own]
        base = sum(math.log10((single[w] + 1) / (n + v + 1)) for w in own)
        score = sum(
            math.log10(chance(tuple(marked[max(0, i - order + 1) : i]), marked[i])) for i in range(1, len(marked))
        )
        known = sum(single[w] > 0 for w in own)
        result.append((doc_id, out, len(own), known, n, base, score))
    return result


def shingles(text, size):
    own = words(text)
    return {tuple(own[i : i + size]) for i in range(max(len(own) - size + 1, 1))} if own else set()


def near_duplicates(rows, size, percent):
    """op7 for (doc_id, text) rows with distinct ids: id -> (set size, component)."""
    sets = {doc_id: shingles(text, size) for doc_id, text in rows}
    root = {doc_id: doc_id for doc_id in sets}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                one, other = find(a), find(b)
                root[max(one, other)] = min(one, other)
    return {doc_id: (len(own), find(doc_id)) for doc_id, own in sets.items()}


ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secret_spans(text):
    """op4's base spans: (start, order of the kind, end)."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def secret_row(text):
    spans = secret_spans(text)
    said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
    counts = [sum(kind == k for _, kind, _ in spans) for k in range(3)]
    return (*counts, hashlib.sha256(said.encode()).hexdigest())


def contamination_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(rows, items, window=10):
    """op3 for (doc_id, text) and (item_id, text) rows."""
    patterns = {}
    for item, text in items:
        own = contamination_words(text)
        for i in range(max(len(own) - window + 1, 1) if own else 0):
            patterns.setdefault(tuple(own[i : i + window]), set()).add(item)
    lengths = {len(p) for p in patterns}
    result = []
    for doc_id, text in rows:
        own = contamination_words(text)
        hit, listed = set(), set()
        for n in lengths:
            for i in range(len(own) - n + 1):
                found = patterns.get(tuple(own[i : i + n]))
                if found is not None:
                    hit.update(range(i, i + n))
                    listed.update(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(sorted(listed)).encode()).hexdigest()
        result.append((doc_id, len(own), len(hit), len(listed), digest, bool(hit)))
    return result
