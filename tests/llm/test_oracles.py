"""Queries that SQL can express against their SQL, at the smallest scale."""

import pytest

from agentlake.llm.queries import ORACLES, QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(duck(SF), QUERIES[name](spark, SF), ORACLES[name]) is None


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
