"""Every registered query against its SQL twin on the smallest data set."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    message, n = compare(spark, con, QUERIES[name], ORACLE.get(name), FOLDER)
    assert message is None, message
    assert name in ORACLE or n > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
