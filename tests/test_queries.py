"""Every registered query against its SQL on the driver tables."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import compare, connect
from marketlake.queries.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

SQL = {name: sql for name, sql in entry_point.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert compare(df, tables, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
