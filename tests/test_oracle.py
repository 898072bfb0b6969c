"""Every query with SQL must give the rows DuckDB gives."""

import os

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert difference(contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).columns == ["query_id", "id", "sim", "rank"]


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
