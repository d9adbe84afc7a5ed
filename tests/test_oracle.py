"""Every registered query on the smallest test data against its DuckDB statement."""

import pytest

import __spark_entry__ as entry
from carelake import catalog, oracle
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_statement():
    assert set(catalog.QUERIES) == set(oracle.statements())
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", oracle.statements())
def test_query_equals_statement(spark, con, name):
    count, problems = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert not problems
    assert count > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 9
