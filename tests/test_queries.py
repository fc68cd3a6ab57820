"""Every registered query against DuckDB; those without SQL must at least run."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, connection, name):
    query = contract.queries()[name]
    if name in SQL:
        compare(spark, connection, FOLDER, query, SQL[name])
    else:
        assert query(spark, FOLDER).columns


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["state", "app_traffic"]
