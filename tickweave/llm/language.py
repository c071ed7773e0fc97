"""Language of code-switched text: a conditional random field labels each word, forward-backward gives the
posterior of each language, and a document's prediction is the language of most posterior weight.

The field is fitted on the driver, on a bounded sample of labelled passages; passages of several languages
are joined into training sequences, so that the learned transitions know switches. Its weights have a fixed
size and are shipped to the tasks, which read every whole text where it lies. A line is a sequence.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every text if there
is nothing to learn from; documents without id are not held out; rows without language are not learned
from; ties between languages go to the first in the alphabet; repeated rows are predicted alike; an empty
table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import crf
from . import words as W

UNDETERMINED = "und"
#: The fit sees at most so many passages, spread evenly over the languages, of at most so many words each
#: and so many characters per word; they come from the documents of the smallest hashes.
PASSAGES, PASSAGE_WORDS, WORD_CHARACTERS = 4_000, 25, 40
DOCUMENTS = 1_000
LEXICON_COUNT = 3


def passages(documents: DataFrame, trained: Column) -> list[tuple[str, str]]:
    """A bounded sample of labelled passages."""
    rows = documents.select("doc_id", F.col("lang").cast("string"), F.col("text").cast("string"))
    rows = rows.filter(trained & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return []
    each, texts = max(PASSAGES // len(sizes), 1), max(DOCUMENTS // len(sizes), 1)
    limits = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, 2.0 * texts / n)])
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    word = rf"[^\s]{{1,{WORD_CHARACTERS}}}"
    cut = F.regexp_extract_all("text", F.lit(rf"({word}(?:\s+{word}){{0,{PASSAGE_WORDS - 1}}})"))
    found = rows.filter(share < limits[F.col("lang")]).select("lang", F.explode(cut).alias("passage"))
    best = Window.partitionBy("lang").orderBy(F.xxhash64("passage"), "passage")
    picked = found.distinct().withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= each)
    return sorted((r["lang"], r["passage"]) for r in picked.select("lang", "passage").collect())


def fit(sample: list[tuple[str, str]]) -> crf.Model | None:
    """A field learned from labelled passages."""
    labels = sorted({lang for lang, _ in sample})
    if not labels:
        return None
    random = np.random.Generator(np.random.PCG64(4242))
    order = random.permutation(len(sample))
    texts = pa.array([sample[i][1] for i in order], pa.string())
    words = crf.find_words(*W.buffers(texts))
    passage = words.owner()
    label = np.array([labels.index(sample[i][0]) for i in order], dtype=np.int64)
    target = label[passage]
    # a sequence is one to three neighbouring passages of the shuffled sample
    joined = np.cumsum(random.random(len(order)) < 0.6)
    hashes = words.hashes()
    lexicons = []
    for mine in range(len(labels)):
        counts = Counter(hashes[target == mine].tolist())
        known = sorted(h for h, n in counts.items() if n >= LEXICON_COUNT)
        lexicons.append(np.array(known, dtype=np.uint64))
    model = crf.Model(labels, lexicons)
    if len(words):
        model.fit(words, joined[passage], target)
    return model


def _lettered(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have a letter."""
    letters = np.concatenate([[0], np.cumsum(crf.LETTERS[data] & (data < 0x80))])
    has = letters[offsets[1:]] > letters[offsets[:-1]]
    for text in np.flatnonzero(~has & (np.diff(offsets) > 0)).tolist():
        has[text] = any(c.isalpha() for c in part.column("text")[text].as_py())
    return has


def _predicted(model: crf.Model | None):
    labels = model.labels if model else [UNDETERMINED]

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.num_rows
        data, offsets = W.buffers(part.column("text"))
        has = _lettered(part, data, offsets) if model else np.zeros(texts, bool)
        best, score = np.zeros(texts, np.int64), np.zeros(texts)
        words = crf.find_words(data, offsets)
        if model and len(words):
            kinds, sample, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
            buckets, first = crf.hashed_features(words, sample)
            emissions = model.emissions(buckets, first, model.listed(kinds))[which]
            owner = words.owner()
            line = np.cumsum(data == 10)[words.start] + owner
            starts = np.flatnonzero(np.diff(line, prepend=-1))
            sizes = np.diff(np.append(starts, len(line)))
            posterior, _ = crf.marginals(emissions, starts, sizes, model.transitions)
            sums = np.stack(
                [np.bincount(owner, posterior[:, j], texts) for j in range(len(labels))], axis=1
            )
            best = sums.argmax(axis=1)
            score = sums.max(axis=1) / np.maximum(words.counts(), 1)
        names = [labels[b] if h else UNDETERMINED for b, h in zip(best.tolist(), has.tolist())]
        return pa.record_batch(
            {
                "row": part.column("row"),
                "held_out": part.column("held_out"),
                "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(np.where(has, np.clip(score, 0, 1), 0.0)),
            }
        )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                yield one(part)

    return predict


def with_language(documents: DataFrame, held_out: Column) -> DataFrame:
    """All columns of every document, and ``held_out, lang_pred, score`` (columns of these names are
    replaced); learned from those not held out."""
    held = F.coalesce(held_out, F.lit(False))
    model = fit(passages(documents, ~held))
    kept = documents.drop("held_out", "lang_pred", "score")
    rows = documents.select(
        F.struct(*[F.col(c) for c in kept.columns]).alias("row"),
        F.col("text").cast("string"),
        held.alias("held_out"),
    )
    schema = T.StructType([T.StructField("row", kept.schema)])
    schema = schema.add("held_out", "boolean").add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(_predicted(model), schema).select("row.*", "held_out", "lang_pred", "score")


def identify(documents: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    found = with_language(documents.select("doc_id", "text", "lang"), held_out)
    return found.select(F.col("doc_id").cast("long"), "held_out", "lang_pred", "score")
