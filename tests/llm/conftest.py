import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))

#: Nulls, empty and very long texts, repeated rows, equal texts and equal ids, odd characters.
ODD = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n ", None),
    (4, LONG, "en"),
    (5, LONG + " one more", "fr"),
    (6, "Same text here, twice over and over again.\nAnd a second line of it.", "en"),
    (6, "Same text here, twice over and over again.\nAnd a second line of it.", "en"),
    (7, "same TEXT here, twice over and over again.\nand a second line of it.", "en"),
    (8, "Éé ça — naïve “quotes” ’s x　y 123 4.5", "fr"),
    (None, "no id at all, but a few words all the same", "en"),
    (None, None, None),
    (9, "12345 +++ ---", "de"),
    (10, "<|endoftext|> a<b\r\nc\x1cd", None),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """ODD with further columns whose names an operator might use itself."""
    more = ["row", "document", "key", "part", "chunk", "marks", "drops", "n_words", "score", "id"]
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string")
    for name in more:
        schema = schema.add(name, "string")
    rows = [(*row, *([None, "x"][i % 2] for i in range(len(more)))) for row in ODD]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture
def folder(tmp_path):
    return lambda name="work": str(tmp_path / name)
