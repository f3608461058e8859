"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from ledgerline.plans import oracle, queries
from tests.check import compare, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    same_names, got, want, _, _ = compare(spark, con, FOLDER, key, QUERIES[key], SQL[key])
    assert same_names and got == want and got
