"""Every registered query against the same query in DuckDB."""

import os

import pytest

import __spark_entry__ as entry
import catalog
import oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: run for name, run in entry.queries().items() if name in catalog.QUERIES}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() <= SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
