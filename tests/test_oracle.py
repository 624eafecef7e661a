"""Every registered query against its SQL on the same tables."""

import pytest
from compare import ROOT, compare, oracle_connection

import __spark_entry__ as entry_points
from pairwarden.catalog import ORACLES, QUERIES

FOLDER = str(ROOT / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    _, problem = compare(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_points(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
