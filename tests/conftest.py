import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from tickweave.schema import TICKS  # noqa: E402
from tickweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_ticks(spark):
    from pyspark.sql import types as T

    schema = T.StructType(list(TICKS.fields)).add("ingest_ordinal", T.LongType())

    def make(rows):
        names = schema.fieldNames()
        data = [
            tuple({**r, "ingest_ordinal": r.get("ingest_ordinal", i)}[n] for n in names)
            for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(data, schema)

    return make
