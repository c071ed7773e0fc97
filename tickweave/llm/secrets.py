"""Secret scan: fixed patterns, and formats learned from what they find.

Base spans come from three patterns. Grammar inference then learns formats: a bounded sample of the base
values of each kind is a labelled set of credentials, from which a probabilistic automaton is inferred;
another one is inferred from a sample of runs that no pattern matched. What base spans leave of a run of
credential characters is a candidate, and so is what lies behind and between its ``=``, ``/``, ``.``, ``+``,
``_`` and ``-``, from any part to any later one: a key name or a path before a value spoils no score. All
are scored by the log-likelihood
ratio of the best format whose every step they take against the others; of overlapping ones the best is
taken, and those of at least ``margin`` are added as kind ``format``.

Spans are given in code points, end exclusive, and cover a whole match (of ``assign``: with its key word).

Defined cases: a null or empty text has no spans; documents without id are scanned and come back without
id; repeated rows are scanned each; without any base span in the corpus no format is learned and none
added; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import automata
from . import words as W

#: The patterns and least lengths of the contract.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16

FORMAT = "format"
MIN_CANDIDATE = 12
#: Up to so many separators the parts of a piece are scored one by one; those of pieces with more, just as
#: completely, side by side (``long_piece``).
MANY_PARTS = 12
SEPARATOR = re.compile(rb"[=/.+_-]")
#: At most so many distinct values of each kind, and of other runs, are learned from: those of the
#: smallest hashes. Longer values than LEARNED_LENGTH are not learned from.
LEARNED_VALUES = 1_000
LEARNED_LENGTH = 200
SHARES = 16
MARGIN = 12.0

_HEX_DIGIT = np.zeros(256, dtype=bool)
_HEX_DIGIT[48:58] = _HEX_DIGIT[97:103] = True
_RUN = np.zeros(256, dtype=bool)
_RUN[list(automata.SYMBOL)] = True
_TO_SYMBOL = bytes(automata.SYMBOL.get(byte, 0) for byte in range(256))


def _runs(data: np.ndarray, offsets: np.ndarray, members: np.ndarray, least: int):
    """Maximal runs of some bytes, of at least a length: texts, starts and ends in all bytes."""
    found = W.split(data, offsets, members, lower=False)
    long = found.end - found.start >= least
    return found.owner()[long], found.start[long], found.end[long]


class Scan:
    """Base spans and candidates of a batch, as bytes within each text."""

    def __init__(self, batch: pa.RecordBatch):
        self.data, self.offsets = W.buffers(batch.column("text"))
        self.raw = self.data.tobytes()
        self.spans: list[list[tuple[int, int, int, int]]] = [[] for _ in range(batch.num_rows)]
        offsets = self.offsets
        marked = np.flatnonzero((self.data == 0x3A) | (self.data == 0x3D))
        for text in np.unique(np.searchsorted(offsets, marked, side="right") - 1).tolist():
            for m in ASSIGN.finditer(self.raw[offsets[text] : offsets[text + 1]]):
                if len(m[2]) >= ASSIGN_VALUE:
                    self.spans[text].append((m.start(), 0, m.end(), m.start(2)))
        places = [m.start() for m in re.finditer(b"AKIA", self.raw)]
        for text in np.unique(np.searchsorted(offsets, places, side="right") - 1).tolist():
            for m in ACCESS.finditer(self.raw[offsets[text] : offsets[text + 1]]):
                if len(m[0]) >= ACCESS_LENGTH:
                    self.spans[text].append((m.start(), 1, m.end(), m.start()))
        for text, start, end in zip(*_runs(self.data, offsets, _HEX_DIGIT, HEX_LENGTH)):
            base = int(offsets[text])
            self.spans[text].append((int(start) - base, 2, int(end) - base, int(start) - base))
        for spans in self.spans:
            spans.sort()

    def values(self) -> Iterator[tuple[int, bytes]]:
        """Kind and value of every base span."""
        for text, spans in enumerate(self.spans):
            for _, kind, end, begin in spans:
                yield kind, self.raw[self.offsets[text] + begin : self.offsets[text] + end]

    def pieces(self) -> Iterator[tuple[int, int, int]]:
        """Text, start and end of what base spans leave of runs; a full stop at the end of a run belongs
        to the sentence."""
        found = _runs(self.data, self.offsets, _RUN, MIN_CANDIDATE)
        for t, a, b in zip(*(x.tolist() for x in found)):
            base, spans = int(self.offsets[t]), self.spans[t]
            a, b = a - base, b - base
            at = max(bisect_left(spans, (a,)) - len(KINDS), 0)  # at most one of each kind reaches into a run
            for start, _, end, _ in spans[at:]:
                if start >= b:
                    break
                if end > a:
                    yield from self._piece(t, a, min(start, b))
                    a = max(a, end)
            yield from self._piece(t, a, b)

    def _piece(self, text: int, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        base = int(self.offsets[text])
        while end > start and self.raw[base + end - 1] == 0x2E:
            end -= 1
        if end - start >= MIN_CANDIDATE:
            yield text, start, end

    def candidates(self, many: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        """Text, start, end and value of every piece and of its parts between separators, from each part to
        each later one. Pieces of more than ``MANY_PARTS`` separators go to ``many`` instead, as text, start
        and value."""
        for text, start, end in self.pieces():
            base = int(self.offsets[text])
            value = self.raw[base + start : base + end]
            begins, ends = _bounds(value)
            if len(begins) > MANY_PARTS + 1:
                many.append((text, start, value))
                continue
            for i, a in enumerate(begins):
                for b in ends[i:]:
                    if b - a >= MIN_CANDIDATE:
                        yield text, start + a, start + b, value[a:b]


def _bounds(value: bytes) -> tuple[list[int], list[int]]:
    """Where the parts of a piece begin and end."""
    cuts = [m.start() for m in SEPARATOR.finditer(value)]
    return [0, *(c + 1 for c in cuts)], [*cuts, len(value)]


def long_piece(
    value: bytes, formats: list[tuple], others: tuple, margin: float
) -> list[tuple[float, int, int]]:
    """What ``_best`` keeps of all candidates of a piece, as (-ratio, start, end), without scoring each pair
    of a begin and an end.

    All begins run through the automata side by side. Of runs of candidate length that meet in the same
    states only the best goes on, as the rest of their way is the same; so each end has its best begin
    after one pass. Once a span is kept, the ends behind it are run anew with begins behind it, as far as
    runs from before its end were still under way.
    """
    symbols = value.translate(_TO_SYMBOL)
    begins, ends = (set(x) for x in _bounds(value))
    steps, logs, stops = others
    best: dict[int, tuple[float, int, int]] = {}
    oldest: dict[int, int] = {}  # by end: the first begin still under way there

    def step(state: tuple, run: tuple, symbol: int) -> tuple[tuple, tuple] | None:
        (f, one, other), (_, total, plain, start) = state, run
        total += formats[f][1][one][symbol]
        one = formats[f][0][one][symbol]
        if one == len(formats[f][0]) - 1:
            return None
        plain += logs[other][symbol]
        return (f, one, steps[other][symbol]), (plain - total, total, plain, start)

    def meet(runs: dict[tuple, tuple], state: tuple, run: tuple) -> None:
        held = runs.get(state)
        if held is None or (run[0], run[3]) < (held[0], held[3]):
            runs[state] = run

    def pass_over(first: int, last: int) -> Iterator[tuple[float, int, int]]:
        """Set the best spans of ends up to ``last`` that begin at ``first`` or later; give the new ones."""
        runs: dict[tuple, tuple] = {}
        young: list[tuple[tuple, tuple]] = []  # shorter than a candidate: not to be left out yet
        for at in range(first, last + 1):
            while young and at - young[0][1][3] >= MIN_CANDIDATE:
                meet(runs, *young.pop(0))
            if at in ends:
                if oldest.get(at, -1) >= first > 0:
                    return
                oldest[at] = min([r[3] for r in runs.values()] + [r[3] for _, r in young[:1]], default=at)
                found = min(
                    (
                        ((plain + stops[other]) - (total + formats[f][2][one]), start, at)
                        for (f, one, other), (_, total, plain, start) in runs.items()
                    ),
                    default=None,
                )
                if found and -found[0] >= margin:
                    best[at] = found
                    yield found
                else:
                    best.pop(at, None)
            if at == last:
                return
            if at in begins:
                young += [((f, 0, 0), (0.0, 0.0, 0.0, at)) for f in range(len(formats))]
            symbol = symbols[at]
            young = [x for x in (step(state, run, symbol) for state, run in young) if x]
            moved, runs = runs, {}
            for state, run in moved.items():
                if (on := step(state, run, symbol)) is not None:
                    meet(runs, *on)

    heap = list(pass_over(0, len(value)))
    heapify(heap)
    kept: list[tuple[int, int, float]] = []
    while heap:
        found = heappop(heap)
        ratio, start, end = found
        if best.get(end) != found:
            continue
        place = bisect_left(kept, (start,))
        kept.insert(place, (start, end, ratio))
        for at in range(start + 1, end + 1):
            best.pop(at, None)
        for new in pass_over(end, kept[place + 1][0] if place + 1 < len(kept) else len(value)):
            heappush(heap, new)
    return [(ratio, start, end) for start, end, ratio in kept]


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct values of a batch with their kind; -1: no base span."""
    for batch in batches:
        for part in W.slices(batch, "text"):
            scan = Scan(part)
            found = set(scan.values())
            found |= {(-1, scan.raw[scan.offsets[t] + a : scan.offsets[t] + b]) for t, a, b in scan.pieces()}
            found = [x for x in found if len(x[1]) <= LEARNED_LENGTH and not set(x[1]) - automata.SYMBOL.keys()]
            yield pa.record_batch(
                {
                    "kind": pa.array([k for k, _ in found], pa.int32()),
                    "value": pa.array([v for _, v in found], pa.binary()),
                }
            )


def learn(documents: DataFrame, limit: int = LEARNED_VALUES) -> tuple[list[tuple], tuple | None]:
    """Automata of the kinds of credentials, and of other runs; from at most ``limit`` values each."""
    found = (
        documents.select(F.col("text").cast("string"))
        .mapInArrow(_samples, "kind int, value binary")
        .distinct()
    )
    # the smallest hashes of each of some shares of a kind, then of the kind: what the last step sees is
    # bounded however many tasks there are
    found = found.withColumn("hash", F.xxhash64("value")).withColumn("share", F.pmod("hash", F.lit(SHARES)))
    picked = found
    for keys in (["kind", "share"], ["kind"]):
        best = Window.partitionBy(*keys).orderBy("hash", "value")
        picked = picked.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= limit)
    samples: dict[int, list[bytes]] = {kind: [] for kind in (-1, *range(len(KINDS)))}
    for row in picked.orderBy("kind", "nth").collect():
        samples[row["kind"]].append(bytes(row["value"]))
    formats = [automata.Automaton(v).tables for k, v in samples.items() if k >= 0 and v]
    others = automata.Automaton(samples[-1]).tables if formats else None
    return formats, others


def _best(scored: list[tuple[float, int, int]]) -> list[tuple[int, int, int, float]]:
    """The best of overlapping spans, then the best of the rest; of equal ones the first."""
    kept: list[tuple[int, int, int, float]] = []
    for ratio, start, end in sorted(scored):
        at = bisect_left(kept, (start,))
        if (at == 0 or kept[at - 1][2] <= start) and (at == len(kept) or kept[at][0] >= end):
            kept.insert(at, (start, len(KINDS), end, -ratio))
    return kept


def _scanned(formats: list[tuple], others: tuple | None, margin: float):
    names = (*KINDS, FORMAT)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                yield one(part)

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        found = Scan(part)
        scored: dict[int, list[tuple[float, int, int]]] = {}
        known: dict[bytes, float] = {}  # words recur within a slice
        many: list[tuple[int, int, bytes]] = []
        for text, start, end, value in found.candidates(many) if formats else ():
            ratio = known.get(value)
            if ratio is None:
                ratio = max(automata.log_likelihood(f, value, known_only=True) for f in formats)
                if ratio > -inf:
                    ratio -= automata.log_likelihood(others, value)
                known[value] = ratio
            if ratio >= margin:
                scored.setdefault(text, []).append((-ratio, start, end))
        whole: dict[bytes, list[tuple[float, int, int]]] = {}
        for text, start, value in many:
            if value not in whole:
                whole[value] = long_piece(value, formats, others, margin)
            for ratio, a, b in whole[value]:
                scored.setdefault(text, []).append((ratio, start + a, start + b))
        added = {text: _best(spans) for text, spans in scored.items()}
        points = np.concatenate([[0], np.cumsum((found.data & 0xC0) != 0x80)])
        rows = {"n": [], "base": [], "all": [], "score": []}
        for text, spans in enumerate(found.spans):
            extra = added.get(text, [])
            begin = int(found.offsets[text])
            first = points[begin]

            def said(kept: list[tuple]) -> str:
                return ",".join(
                    f"{names[k]}:{points[begin + a] - first}:{points[begin + b] - first}"
                    for a, k, b, _ in kept
                )

            rows["n"].append([sum(s[1] == k for s in spans) for k in range(len(KINDS))])
            rows["base"].append(hashlib.sha256(said(spans).encode()).hexdigest())
            rows["all"].append(said(sorted([*spans, *extra], key=lambda s: s[:3])))
            rows["score"].append(max((s[3] for s in extra), default=None))
        counts = np.array(rows["n"], dtype=np.int64).reshape(-1, len(KINDS))
        return pa.record_batch(
            {
                "doc_id": part.column("doc_id"),
                **{f"n_{kind}": pa.array(counts[:, k]) for k, kind in enumerate(KINDS)},
                "base_sha256": pa.array(rows["base"], pa.string()),
                "spans": pa.array(rows["all"], pa.string()),
                "format_score": pa.array(rows["score"], pa.float64()),
            }
        )

    return scan


def find_secrets(documents: DataFrame, margin: float = MARGIN, limit: int = LEARNED_VALUES) -> DataFrame:
    """Per document the counts of base spans by kind, their sha256, all spans as
    ``kind:start:end,...`` and the best score of an added one."""
    formats, others = learn(documents, limit)
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        _scanned(formats, others, margin),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
        "format_score double",
    )
