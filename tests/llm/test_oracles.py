"""The registered queries that SQL can express, against their SQL."""

import pytest

from delayworks.llm import queries
from tests.harness import compare, connect


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(name, spark, small):
    assert compare(queries.QUERIES[name](spark, small), connect(small), queries.ORACLES[name]) is None


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
