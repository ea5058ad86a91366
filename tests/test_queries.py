"""Every registered query agrees with its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as registered
from oracle import mismatch

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


NAMES = [query.__name__ for query in registered.QUERIES]


def test_every_query_has_sql():
    assert registered._lineitem_sql().keys() == set(NAMES)
    assert set(NAMES) <= registered.queries().keys()
    assert registered.oracle_sql().keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    query, sql = registered.queries()[name], registered.oracle_sql()[name]
    assert mismatch(spark, query, sql, SF_DIR) is None


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["file_name", "count"]
    assert df.count() == 3
