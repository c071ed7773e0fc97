"""Line dedup by a log-template tree.

A line goes down a tree of fixed depth: by its number of tokens, then by its leading tokens. Tokens with a
digit are variable fields from the start. In a leaf, a token is constant at its position if lines of at
least ``min_docs`` documents have it there; any other is a variable field. The constant tokens with their
positions are the line's template. A template recurs if at least ``min_docs`` documents have it and at
least ``constant_share`` of its tokens are constant. Its first line (smallest doc_id, then smallest line
number) stays, all others are dropped, so a passage is never lost.

With ``pairs`` a line that no recurring template covers recurs as it is, if two documents have it and at
least ``constant_share`` of its tokens are no variable fields from the start. Documents of the same words on
the same lines are copies, which count as one there and keep or lose such a line alike, so that a
near-duplicate join still links them.

Counting is done by aggregations over lines and over the tokens of one sample per distinct line, in leaves
that enough documents reach; no leaf is ever gathered in one place. Texts move twice: to fetch samples and
to drop lines.

Defined cases: a null text stays null, an empty one empty; lines of fewer than ``min_tokens`` tokens, empty
ones too, always stay; lines are what lies between line feeds; tokens are compared in lower case (A-Z);
rows with equal id and text are one document, cleaned alike; documents without id come last when the first
line of a template is sought; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

FIELD = W.U64(0x2545F4914F6CDD1D)  # stands for a variable field
_DIGIT = ~W.not_in((0x30, 0x39))


def _tokens(batch: pa.RecordBatch) -> tuple[W.Words, np.ndarray, np.ndarray]:
    """Words, their hashes with variable fields made equal, and the line of each word, counted over all
    texts (every text begins a line)."""
    found = W.batch_words(batch, "text", W.SPACED)
    hashes = found.hashes()
    digits = np.concatenate([[0], np.cumsum(_DIGIT[found.data])])
    hashes[digits[found.end] > digits[found.start]] = FIELD
    feeds = np.cumsum(found.data == 10)
    line = np.zeros(len(found), dtype=np.int64)
    if len(found):
        line = feeds[found.start]
    return found, hashes, line + found.owner()


def _contents(found: W.Words, line: np.ndarray) -> np.ndarray:
    """A hash of each text's words and the lines they are on."""
    owner = found.owner()
    turn = np.arange(len(found)) - found.first[owner]
    place = W.mix(turn.astype(np.uint64)) + line.astype(np.uint64)
    sums = np.concatenate([[W.U64(0)], np.cumsum(W.mix(found.hashes() + W.mix(place)))])
    return sums[found.first[1:]] - sums[found.first[:-1]]


def _lines(depth: int, min_tokens: int, pairs: bool):
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                found, hashes, line = _tokens(part)
                first = np.flatnonzero(np.diff(line, prepend=-1))
                size = np.diff(np.append(first, len(line)))
                long = size >= min_tokens
                place = np.arange(len(line)) - np.repeat(first, size)
                sums = np.add.reduceat(W.mix(hashes + W.mix(place.astype(np.uint64))), first) if len(
                    first
                ) else np.zeros(0, np.uint64)
                first, size, sums = first[long], size[long], sums[long]
                leaf = W.mix(size.astype(np.uint64))
                for step in range(depth):
                    has = size > step
                    leaf[has] = W.mix(leaf[has] * W.U64(3) + hashes[first[has] + step])
                text = found.owner()[first]
                _, offsets = W.buffers(part.column("text"))
                feeds = np.concatenate([[0], np.cumsum(found.data == 10)])
                number = line[first] - text - feeds[offsets[text]]
                columns = {
                    "document": part.column("document").take(pa.array(text)),
                    "doc_id": part.column("doc_id").take(pa.array(text)),
                    "number": pa.array(number, pa.int32()),
                    "leaf": pa.array(leaf.view(np.int64)),
                    "line": pa.array(W.mix(sums + leaf).view(np.int64)),
                }
                if pairs:
                    owner = found.owner()
                    contents = _contents(found, line - owner - feeds[offsets[owner]])
                    columns["content"] = pa.array(contents[text].view(np.int64))
                yield pa.record_batch(columns)

    return lines


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of chosen lines: rows of ``text``, and ``picks`` of number, leaf and line."""
    for batch in batches:
        for part in W.slices(batch, "text"):
            found, hashes, line = _tokens(part)
            _, offsets = W.buffers(part.column("text"))
            feeds = np.concatenate([[0], np.cumsum(found.data == 10)])
            picks = part.column("picks")
            flat = picks.flatten()
            counts = np.array([len(p) for p in picks], dtype=np.int64)
            text = np.repeat(np.arange(part.num_rows), counts)
            number = flat.field("number").to_numpy(zero_copy_only=False)
            wanted = number + text + feeds[offsets[text]]
            low = np.searchsorted(line, wanted, side="left")
            size = np.searchsorted(line, wanted, side="right") - low
            pick = np.repeat(np.arange(len(flat)), size)
            position = np.arange(len(pick)) - np.repeat(np.cumsum(size) - size, size)
            yield pa.record_batch(
                {
                    "leaf": flat.field("leaf").take(pa.array(pick)),
                    "line": flat.field("line").take(pa.array(pick)),
                    "position": pa.array(position, pa.int32()),
                    "token": pa.array(hashes[low[pick] + position].view(np.int64)),
                }
            )


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in W.slices(whole, "text")):
        lines, dropped, texts = [], [], []
        for text, drops in zip(batch.column("text").to_pylist(), batch.column("drops").to_pylist()):
            parts = [] if text is None else text.split("\n")
            out = set(drops or ())
            lines.append(len(parts))
            dropped.append(len(out))
            if out:
                text = "\n".join(part for i, part in enumerate(parts) if i not in out)
            texts.append(text)
        yield pa.record_batch(
            [batch.column("row"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
             pa.array(texts, pa.string())],
            names=["row", "n_lines", "n_dropped", "text"],
        )


def recurring_lines(
    documents: DataFrame, work: str, min_docs: int = 3, min_tokens: int = 3, depth: int = 3,
    constant_share: float = 0.75, pairs: bool = False,
) -> DataFrame:
    """Lines to drop: ``document`` (a hash of id and text) and the line ``number`` from 0."""
    spark = documents.sparkSession
    keyed = documents.select("document", F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "document long, doc_id long, number int, leaf long, line long"
    keyed.mapInArrow(
        _lines(depth, min_tokens, pairs), schema + ", content long" if pairs else schema
    ).write.option("compression", "zstd").parquet(f"{work}/lines")
    lines = spark.read.parquet(f"{work}/lines")
    numbers, counts = [F.min("number").alias("number")], [F.count(F.lit(1)).alias("docs")]
    if pairs:
        numbers.append(F.first("content").alias("content"))
        counts.append((F.min("content") != F.max("content")).alias("paired"))
    support = (
        lines.groupBy("leaf", "line", "document")
        .agg(*numbers)
        .groupBy("leaf", "line")
        .agg(*counts, F.min(F.struct("document", "number")).alias("sample"))
    )
    support.write.option("compression", "zstd").parquet(f"{work}/support")
    support = spark.read.parquet(f"{work}/support")
    reach = F.sum("docs") >= min_docs
    if pairs:
        reach |= F.max("paired")
    reached = support.groupBy("leaf").agg(reach.alias("enough")).filter("enough")
    candidates = support.join(reached.select("leaf"), "leaf")
    picks = candidates.groupBy(F.col("sample.document").alias("document")).agg(
        F.collect_list(F.struct("sample.number", "leaf", "line")).alias("picks")
    )
    tokens = (
        keyed.select("document", "text")
        .join(picks, "document")
        .dropDuplicates(["document"])
        .select("text", "picks")
        .mapInArrow(_sampled, "leaf long, line long, position int, token long")
    )
    tokens.write.option("compression", "zstd").parquet(f"{work}/tokens")
    weighed = spark.read.parquet(f"{work}/tokens").join(support.drop("sample"), ["leaf", "line"])
    place = ["leaf", "position", "token"]
    worded = F.col("token") != F.lit(int(FIELD.view(np.int64)))
    constant = (
        weighed.filter(worded)
        .groupBy(*place)
        .agg(F.sum("docs").alias("seen"))
        .filter(F.col("seen") >= min_docs)
    )
    marked = weighed.join(constant, place, "left").withColumn("fixed", F.col("seen").isNotNull())
    templates = marked.groupBy("leaf", "line").agg(
        F.first("docs").alias("docs"),
        F.count(F.lit(1)).alias("tokens"),
        F.count_if("fixed").alias("constants"),
        F.sum(F.when(F.col("fixed"), F.xxhash64("position", "token").cast("decimal(20,0)"))).alias("shape"),
    ).select(
        "line", "docs", F.xxhash64("leaf", F.coalesce("shape", F.lit(0).cast("decimal(30,0)"))).alias("template")
    , (F.col("constants") >= F.col("tokens") * constant_share).alias("firm"))
    common = (
        templates.filter("firm").groupBy("template").agg(F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= min_docs).select("template")
    )
    recurring = templates.filter("firm").select("line", "template").join(common, "template")
    recurring.write.parquet(f"{work}/recurring")  # tables on one side let the joins split hot keys
    drops = _later(lines, f"{work}/recurring", f"{work}/first", "document")
    if pairs:
        whole = (
            weighed.groupBy("leaf", "line")
            .agg(F.count(F.lit(1)).alias("tokens"), F.count_if(worded).alias("words"), F.first("paired").alias("paired"))
            .filter(F.col("paired") & (F.col("words") >= F.col("tokens") * constant_share))
            .join(spark.read.parquet(f"{work}/recurring").select("line"), "line", "left_anti")
        )
        whole.select("line", F.col("line").alias("template")).write.parquet(f"{work}/paired")
        drops = drops.unionByName(_later(lines, f"{work}/paired", f"{work}/first-paired", "content"))
    return drops.distinct()


def _later(lines: DataFrame, recurring: str, work: str, place: str) -> DataFrame:
    """``document`` and ``number`` of all lines of the templates in ``recurring`` but the first of each and
    those that agree with it in ``place`` and number."""
    spark = lines.sparkSession
    found = lines.join(spark.read.parquet(recurring), "line")
    found.groupBy("template").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "document", "number", F.col(place).alias("place"))).alias("first")
    ).write.parquet(work)
    return (
        found.join(spark.read.parquet(work), "template")
        .filter((F.col("first.place") != F.col(place)) | (F.col("first.number") != F.col("number")))
        .select("document", "number")
    )


def drop_recurring(documents: DataFrame, work: str, **settings) -> DataFrame:
    """All columns of the documents, ``text`` without dropped lines, and ``n_lines`` and ``n_dropped``
    (columns of these names are replaced). ``work`` is an empty shared folder; see ``recurring_lines``."""
    kept = documents.drop("text", "n_lines", "n_dropped")
    keyed = documents.select(
        F.struct(*[F.col(c) for c in kept.columns]).alias("row"),
        F.xxhash64("doc_id", "text").alias("document"),
        "doc_id",
        F.col("text").cast("string"),
    )
    drops = (
        recurring_lines(keyed.select("document", "doc_id", "text"), work, **settings)
        .groupBy("document")
        .agg(F.collect_list("number").alias("drops"))
    )
    joined = keyed.drop("doc_id").join(drops, "document", "left").select("row", "text", "drops")
    schema = T.StructType([T.StructField("row", kept.schema)])
    schema = schema.add("n_lines", "long").add("n_dropped", "long").add("text", "string")
    return joined.mapInArrow(_cleaned, schema).select("row.*", "n_lines", "n_dropped", "text")
