"""Every query against its SQL counterpart, at the smallest scale factor."""

import os
import sys

import pytest

import __spark_entry__ as contract

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.duck(SF)


def test_keys_belong_together():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    ok, message, _ = compare.compare(spark, connection, SF, name, QUERIES[name], SQL[name])
    assert ok, message


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()
