"""The registered queries of the folder against their SQL."""

import os

import pytest

from wharfline.llm.registry import ORACLE_SQL, QUERIES
from workload.check import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLE_SQL[name]) is None
