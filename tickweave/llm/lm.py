"""N-gram language model as a weighted backoff automaton, trained and applied over a whole corpus.

A state is a seen history of up to ``order - 1`` words (the root is the empty one); a text begins with a mark
of its own. A state's arc for a seen word carries the smoothed probability

    p(w | h) = (c(h w) + T(h) * p(w | shorter h)) / (c(h) + T(h)),   T(h) = strength * c(h) ** growth

and leads to the state of the longest seen end of ``h w``. Its failure arc leads to the next shorter history
and carries ``T(h) / (c(h) + T(h))``; the root holds ``(c(w) + 1) / (N + V + 1)`` for every word, where
1 / (N + V + 1) is left for unknown ones. So each state's probabilities sum to one. A text is walked once
from left to right: the walk carries its state, follows failure arcs until the state has an arc for the next
word, takes that arc, and adds up the logarithms on the way.

No table of n-grams is ever gathered in one place. Texts are dealt to chunks of bounded size. Each chunk
sends the distinct n-grams of its texts, as packed 56-bit hashes with their training counts, to shards by
hash; a shard adds them up and answers each chunk with the totals, in the order of its request. The chunk
builds the part of the automaton that its texts can reach, and walks them. A frequent n-gram is one entry per
chunk, so no shard is hot. All steps are rows of bounded size through ``mapInArrow``; Spark sorts, joins and
regroups them. Requests and answers travel as differences in byte planes, compressed, since their size is
what limits the order.

Defined cases: a null or empty text is its end alone; a document without id is trained on; repeated rows
count and are scored each; an empty table gives no rows; with no training rows every word is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W

CHUNK_BYTES = 10 << 20
WALK_TOKENS = 1 << 16
KEY_BITS = 56
_START, _END = W.U64(0x5BD1E995A3C59AC3), W.U64(0x1F83D9ABFB41BD6B)
_REQUEST = "chunk long, level int, shard int, keys binary, counts binary"
_ANSWER = "chunk long, level int, shard int, extra binary"
_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed: small ones take little."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueezed(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def _row_texts(documents: pa.StructArray) -> pa.RecordBatch:
    """The documents of a chunk."""
    names = ["doc_id", "held_out", "text"]
    return pa.record_batch([documents.field(name) for name in names], names=names)


class Grams:
    """The tokens of some texts: words, then one end; and the distinct n-grams that end at each token.

    Without ``places`` only the n-grams with their counts are kept, not where they stand: a request and a
    count need no more.
    """

    def __init__(self, batch: pa.RecordBatch, order: int, places: bool = True):
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for part in W.slices(batch, "text"):
            found = W.batch_words(part, "text", W.SPACED)
            hashes.append(found.hashes())
            counts.append(found.counts())
        words, size = np.concatenate(hashes), np.concatenate(counts) + 1
        self.ends = np.cumsum(size)
        self.begins = self.ends - size
        token = np.full(len(words) + len(size), _END, dtype=np.uint64)
        is_word = np.ones(len(token), dtype=bool)
        is_word[self.ends - 1] = False
        token[is_word] = words
        del hashes, words, is_word
        self.owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
        self.at = (np.arange(len(token)) - self.begins[self.owner]).astype(np.int32)  # before it in its text
        held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        train = ~held[self.owner]
        self.keys, self.counts, self.first, self.which = [], [], [], []
        key = W.mix(token)
        for n in range(1, order + 1):
            if n > 1:
                before = np.roll(key, 1)
                before[self.at == 0] = _START
                key = W.mix(before * W.U64(2 * n + 1) + token)
            whole = np.flatnonzero(self.at >= n - 2)  # the mark before a text stands for a word
            short = key[whole] >> W.U64(64 - KEY_BITS)
            if not places:
                keys, counts = _counted(short, train[whole])
                self.keys.append(keys)
                self.counts.append(counts)
                continue
            keys, first, which = np.unique(short, return_index=True, return_inverse=True)
            self.keys.append(keys)
            self.counts.append(np.bincount(which, train[whole], len(keys)).astype(np.int32))
            self.first.append(whole[first].astype(np.int32))
            placed = np.full(len(token), -1, dtype=np.int32)
            placed[whole] = which
            self.which.append(placed)


def _counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each is marked; the mark is sorted along as the lowest bit,
    so no array of places is made."""
    marked = keys << W.U64(1)
    marked |= train
    marked.sort()
    marks = (marked & W.U64(1)).astype(np.int32)
    marked >>= W.U64(1)
    begins = np.flatnonzero(np.diff(marked, prepend=~marked[:1]))
    return marked[begins], np.add.reduceat(marks, begins, dtype=np.int32) if len(begins) else marks


class Automaton:
    """The part of the automaton that some texts reach.

    Level ``n`` holds the n-grams of ``n + 1`` words. Seen ones of a level below the last are states; each
    seen one is the arc that leads from the state of its words but the last. ``target`` is the length of the
    history that a taken arc leads to.
    """

    def __init__(self, grams: Grams, totals: list[np.ndarray], tokens: int, types: int, strength, growth):
        self.grams, self.order = grams, len(totals)
        starts = totals[0][grams.which[0][grams.ends[0] - 1]] if len(grams.ends) else 0  # as many as ends
        self.starts = int(starts)
        root = (totals[0] + 1) / (tokens + types + 1)
        chance, self.arcs, self.failures = root, [np.log10(root)], []
        for level in range(1, self.order):
            count, at = totals[level], grams.first[level]
            history = totals[level - 1][grams.which[level - 1][at - 1]]
            if level == 1:
                history = np.where(grams.at[at] == 0, starts, history)
            seen = count > 0
            history = np.where(seen, history, 1).astype(np.float64)
            weight = strength * history**growth
            shorter = chance[grams.which[level - 1][at]]
            chance = (count + weight * shorter) / (history + weight)
            self.arcs.append(np.where(seen, np.log10(chance), 1.0))  # 1: there is no such arc
            self.failures.append(self._failure(totals[level - 1], strength, growth))
            grams.first[level] = None
        self.start_failure = float(self._failure(np.array([starts]), strength, growth)[0])
        self.known = totals[0] > 0

    @staticmethod
    def _failure(count: np.ndarray, strength: float, growth: float) -> np.ndarray:
        history = np.where(count > 0, count, 1).astype(np.float64)
        weight = strength * history**growth
        return np.log10(weight / (history + weight))

    def walk(self) -> np.ndarray:
        """The log-probability of each text, by one walk from its first word to its end.

        The walk takes some thousand words at a time, so that only they are held as Python numbers.
        """
        which, last = self.grams.which, self.order - 1
        begin_state = 1 if self.starts and last else 0
        scores, ends = np.zeros(len(self.grams.ends)), self.grams.ends.tolist()
        text, state, score = 0, begin_state, 0.0
        for low in range(0, len(self.grams.at), WALK_TOKENS):
            part = slice(low, low + WALK_TOKENS)
            # -1: there is no such n-gram
            arcs = [np.append(arc, 1.0)[own[part]].tolist() for arc, own in zip(self.arcs, which)]
            failures = [[], *(self._failures(level, part).tolist() for level in range(last))]
            known = self.known[which[0][part]].tolist()
            for place in range(len(known)):
                arc = arcs[state][place]
                while arc > 0:
                    score += failures[state][place]
                    state -= 1
                    arc = arcs[state][place]
                score += arc
                if state or known[place]:
                    state = min(state + 1, last)
                if low + place + 1 == ends[text]:
                    scores[text] = score
                    text, state, score = text + 1, begin_state, 0.0
        return scores

    def _failures(self, level: int, part: slice) -> np.ndarray:
        """Weights of the failure arcs of the states that the words of a part are read in."""
        low = part.start
        before = self.grams.which[level][max(low - 1, 0) : part.stop - 1]
        found = np.append(self.failures[level], 0.0)[before]
        if low == 0:
            found = np.concatenate([[0.0], found])
        found = found[: len(self.grams.at[part])]
        if level == 0:
            found[self.grams.at[part] == 0] = self.start_failure
        return found


def _types(shards: int):
    """The distinct words of training texts with their counts, to shards."""

    def types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, size = [], 0
        for batch in batches:
            batch = batch.filter(pc.invert(batch.column("held_out")))
            for part in W.slices(batch, "text", CHUNK_BYTES):
                grams = Grams(part, 1, places=False)
                pool.append((grams.keys[0], grams.counts[0]))
                size += len(pool[-1][0])
                if size > 1 << 21:
                    pool = [_summed(pool)]
                    if len(pool[0][0]) > 1 << 20:
                        yield from _requests(0, [pool[0][0]], [pool[0][1]], shards)
                        pool = []
                    size = sum(len(keys) for keys, _ in pool)
        if pool:
            keys, counts = _summed(pool)
            yield from _requests(0, [keys], [counts], shards)

    return types


def _summed(pool: list) -> tuple[np.ndarray, np.ndarray]:
    keys, which = np.unique(np.concatenate([keys for keys, _ in pool]), return_inverse=True)
    counts = np.concatenate([counts for _, counts in pool])
    return keys, np.bincount(which, counts, len(keys)).astype(np.int64)


def cut(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards that ascending keys lie in, and where each one's begin and the last ends."""
    lead = keys >> W.U64(KEY_BITS - 32)
    shard = (lead * W.U64(shards) >> W.U64(32)).astype(np.int64)
    edges = np.searchsorted(shard, np.arange(shards + 1))
    used = np.flatnonzero(np.diff(edges))
    return used, np.append(edges[used], len(shard))


def _requests(chunk: int, keys: list, counts: list, shards: int) -> Iterator[pa.RecordBatch]:
    """A row per level and shard of some n-grams with their counts."""
    for level, (own, numbers) in enumerate(zip(keys, counts)):
        used, edges = cut(own, shards)
        parts = [slice(a, b) for a, b in zip(edges, edges[1:])]
        yield pa.record_batch(
            {
                "chunk": pa.array(np.full(len(used), chunk), pa.int64()),
                "level": pa.array(np.full(len(used), level), pa.int32()),
                "shard": pa.array(used, pa.int32()),
                "keys": pa.array([squeezed(np.diff(own[p], prepend=W.U64(0))) for p in parts], pa.binary()),
                "counts": pa.array([squeezed(numbers[p]) for p in parts], pa.binary()),
            }
        )


def _request(order: int, shards: int):
    def request(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                grams = Grams(_row_texts(batch.column("documents")[row].values), order, places=False)
                keys, counts = grams.keys, grams.counts
                del grams  # the tokens are not held while the requests go out
                yield from _requests(batch.column("chunk")[row].as_py(), keys, counts, shards)
                del keys, counts

    return request


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list]]:
    """The requests of each level and shard in turn, from rows sorted by both."""
    own, rows = None, []
    for batch in batches:
        for chunk, level, shard, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if own is not None and own != (level, shard):
                yield *own, rows
                rows = []
            own = level, shard
            rows.append((chunk, np.cumsum(unsqueezed(keys)), unsqueezed(counts).view(np.int64)))
    if rows:
        yield *own, rows


def _totals(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """The training counts of a shard's n-grams, and which n-gram each requested key is."""
    seen, which = np.unique(np.concatenate([keys for _, keys, _ in rows]), return_inverse=True)
    counts = np.concatenate([counts for *_, counts in rows])
    return np.bincount(which, counts, len(seen)).astype(np.int64), which


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each chunk what the others add to its own counts, in the order of its request."""
    for level, shard, rows in _shards(batches):
        totals, which = _totals(rows)
        at, extra = 0, []
        for _, keys, counts in rows:
            extra.append(squeezed(totals[which[at : at + len(keys)]] - counts))
            at += len(keys)
        yield pa.record_batch(
            {
                "chunk": pa.array([chunk for chunk, *_ in rows], pa.int64()),
                "level": pa.array([level] * len(rows), pa.int32()),
                "shard": pa.array([shard] * len(rows), pa.int32()),
                "extra": pa.array(extra, pa.binary()),
            }
        )


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, rows in _shards(batches):
        totals, _ = _totals(rows)
        yield pa.record_batch(
            {"n_types": pa.array([np.count_nonzero(totals)], pa.int64()), "n_tokens": pa.array([totals.sum()], pa.int64())}
        )


def _scorer(order: int, tokens: int, types: int, strength: float, growth: float):
    def scored(documents: pa.StructArray, answers: pa.StructArray) -> pa.RecordBatch:
        batch = _row_texts(documents)
        grams = Grams(batch, order)
        parts = sorted(
            zip(*(answers.field(c).to_pylist() for c in ("level", "shard", "extra"))), key=lambda part: part[:2]
        )
        totals = []
        grams.keys.clear()
        for level in range(order):
            extra = [unsqueezed(packed).view(np.int64) for own, _, packed in parts if own == level]
            totals.append(np.concatenate([np.zeros(0, np.int64), *extra]))
            totals[level] += grams.counts[level]
            grams.counts[level] = None
        del parts
        automaton = Automaton(grams, totals, tokens, types, strength, growth)
        texts, first = batch.num_rows, grams.which[0]
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "n_tokens": pa.array(grams.ends - grams.begins, pa.int64()),
                "n_known": pa.array(np.bincount(grams.owner, automaton.known[first], texts).astype(np.int64)),
                "train_tokens": pa.array(np.full(texts, tokens), pa.int64()),
                "base_score": pa.array(np.bincount(grams.owner, automaton.arcs[0][first], texts)),
                "score": pa.array(automaton.walk()),
            }
        )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield scored(batch.column("documents")[row].values, batch.column("answers")[row].values)

    return score


def score(
    documents: DataFrame, held_out: Column, order: int = 3, strength: float = 2.0, growth: float = 0.9,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Score all documents with a model of those that are not held out; logarithms to base 10.

    ``base_score`` is the root's alone.
    """
    if order < 1:
        raise ValueError("the order is at least 1")
    spark = documents.sparkSession
    rows = documents.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    size = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // chunk_bytes))

    def dealt(requests: DataFrame) -> DataFrame:
        return requests.repartition(chunks, "shard").sortWithinPartitions("level", "shard")

    words = rows.select("held_out", "text").mapInArrow(_types(chunks), _REQUEST)
    root = dealt(words).mapInArrow(_sizes, "n_types long, n_tokens long")
    root = root.agg(F.sum("n_tokens"), F.sum("n_types")).first()
    # never null, so that the join below filters neither use of the bundles
    chunk = F.coalesce(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)), F.lit(0)).alias("chunk")
    # texts are shuffled once: both uses of the bundles read the same exchange
    bundles = rows.select(chunk, "doc_id", "held_out", "text").repartition(chunks, "chunk").groupBy("chunk").agg(
        F.collect_list(F.struct("doc_id", "held_out", "text")).alias("documents")
    )
    requests = bundles.mapInArrow(_request(order, chunks), _REQUEST)
    answers = dealt(requests).mapInArrow(_answer, _ANSWER).repartition(chunks, "chunk").groupBy("chunk").agg(
        F.collect_list(F.struct("level", "shard", "extra")).alias("answers")
    )
    return bundles.join(answers, "chunk").select("documents", "answers").mapInArrow(
        _scorer(order, root[0] or 0, root[1] or 0, strength, growth), _SCORES
    )
