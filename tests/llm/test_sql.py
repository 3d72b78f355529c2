"""Queries of the llm subpackage against their SQL."""

import os

import pytest

from searchmill.llm.queries import QUERIES, SQL
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, con, name):
    more, less, n = differences(QUERIES[name](spark, SF_DIR), con, SQL[name])
    assert n and not more and not less
