"""Every registered query against its SQL."""

import os

import pytest

from workload.check import compare, connect
from workload.oracle import ORACLE_SQL
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLE_SQL[name]) is None


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
