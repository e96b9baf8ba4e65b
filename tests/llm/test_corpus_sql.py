"""Queries of the corpus operators against their SQL, on the smallest tables."""

import pytest
from compare import connect, difference

from tidemark.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, data, name):
    assert difference(registry.queries()[name](spark, data), connect(data), registry.oracle_sql()[name]) == ([], [], [])
