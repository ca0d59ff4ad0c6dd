"""Every registered query against its SQL, and the driver entry."""

import pytest

import __spark_entry__ as entry
from check import compare, oracle
from ledgermill.checks.catalogue import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle("/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, "/root/testdata/sf0.001") is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_id", "status", "segment", "price"]
    assert df.count() > 0
