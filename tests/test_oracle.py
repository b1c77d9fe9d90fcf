"""Every registered query with SQL gives DuckDB's rows."""

import pytest

import __spark_entry__ as entry
from catalog.compare import compare, duck
from catalog.oracle import oracle_texts
from catalog.queries import QUERIES as CATALOG

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, sf_dir, name):
    same, note = compare(spark, con, sf_dir, name, QUERIES[name], SQL[name])
    assert same, note


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(CATALOG) == set(oracle_texts())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
