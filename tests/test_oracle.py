"""Every registered query against its independent SQL, on the smallest tables."""

import pytest
from compare import connect, difference

from tidemark.plans import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    assert difference(QUERIES[name](spark, data), con, ORACLE[name]) == ([], [], [])
