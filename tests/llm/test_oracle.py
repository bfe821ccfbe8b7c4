"""The queries that SQL can express, against it."""

import pytest
from oracle import compare, connect

from stackroom.llm.oracle import ORACLE_SQL
from stackroom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, con, name):
    more, less, count, _ = compare(QUERIES[name](spark, FOLDER), con, ORACLE_SQL[name])
    assert not more and not less and count
