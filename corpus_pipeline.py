"""The corpus pipeline: stages over ``documents``, each written to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import decontaminate, jaccard, language, line_dedup, packing
from tickweave.llm.queries import id_remainder, table, tokenizer_file
from tickweave.session import shared_folder

#: A document is rejected by language ID if its best language is so little above chance, on a scale from
#: 0, where all learned languages have equal posterior weight, to 1. A text that switches evenly between two
#: of three and more languages lies above it, one that holds words of all alike does not. Of two languages
#: the better one never has less than half, so then only texts without a letter go.
LEAST_ABOVE_CHANCE = 0.2
EVEN_SWITCH = 0.45


def least_language_score(languages: int) -> float:
    """The posterior weight that the best of so many languages has to have."""
    chance = 1 / max(languages, 1)
    return min(chance + LEAST_ABOVE_CHANCE * (1 - chance), max(EVEN_SWITCH, chance))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter (null and empty texts among them) and those of no clear language;
    fill a missing ``lang``. Without any labelled document all go, since no language is known; repeated
    rows are judged alike, and an empty table stays empty."""
    languages = docs.filter("text IS NOT NULL").agg(F.count_distinct("lang")).first()[0]
    seen = F.col("lang_pred") != language.UNDETERMINED
    kept = language.with_language(docs, id_remainder(4) == 2).filter(
        seen & (F.col("score") >= least_language_score(languages))
    )
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop recurring lines from the texts, also those that just two documents share; copies of a whole
    document in two are left to the next stage. A document that loses all its words by that goes, since
    each of its lines is held by another; one that had none before stays, as do rows without id, and
    repeated rows lose the same lines."""
    cleaned = line_dedup.drop_recurring(docs, shared_folder(spark, "line-dedup"), pairs=True)
    emptied = (F.col("n_dropped") > 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = cleaned.filter(~emptied)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group of near duplicates; rows with equal ids
    are one document, and rows without id stay."""
    found = jaccard.near_duplicates(docs, shared_folder(spark, "jaccard"), shingle_words=5, percent=80)
    drops = found.filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(drops, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item; texts without words and all documents of an
    empty benchmark stay."""
    found = decontaminate.with_contamination(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.filter("NOT contaminated").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 ids; an empty text is a piece of its end alone."""
    return packing.pack(
        docs, shared_folder(spark, "packing"), tokenizer_file("byte_bpe_50k.json"),
        vocabulary=50_257, cut="spaced", end_id=0,
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Learned language ID and tokenization can't be said in SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that pass all stages."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
