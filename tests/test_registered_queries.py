"""All registered queries against their SQL in DuckDB, on the smallest tables."""

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

from check_queries import compare  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

TABLES = pathlib.Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="the test tables are not here")


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, name):
    assert compare(spark, str(TABLES), name) is None


def test_entry(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).count() > 0
