"""Every registered query runs, and equals its SQL where there is some."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import differences, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_sql_only_for_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["group", "total", "flagged", "flag_rate"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert differences(df, connection, SQL[name]) == []
    else:
        assert df.count() > 0
