"""Every registered query against its DuckDB statement."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fixtures.registry import ORACLE, QUERIES
from tests.compare import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches(spark, name):
    assert compare(spark, queries(), oracle_sql(), name, SF_DIR) is None


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns[:4] == ["date", "shift", "workstation", "category"]
    assert frame.count() > 0


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE) <= set(oracle_sql()) <= set(queries())
