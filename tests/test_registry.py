"""Every registered query against DuckDB on the smallest driver tables."""

from __future__ import annotations

import __spark_entry__ as contract
import pytest
from compare import difference, duck
from registry import catalog

SF = "/root/testdata/sf0.001"
# The text operators have tests of their own.
QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None
