"""Every query with SQL against that SQL, on the smallest data set."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    line = check.compare(spark, con, SF, name)
    assert not line.startswith("FAIL"), line


def test_entry(spark):
    got = entry.entry(spark)
    assert got.count() > 0 and "quality_grade" in got.columns


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
