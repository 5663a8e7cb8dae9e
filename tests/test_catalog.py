"""Every registered query against its SQL twin on the smallest data set."""

import os

import pytest
from oracle import compare, connect

from tallyhouse.catalog import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("query", all_queries(), ids=lambda q: q.name)
def test_query(spark, duck, query):
    ok, note = compare(spark, duck, query, SF_DIR)
    assert ok, note


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[0] == "date"
