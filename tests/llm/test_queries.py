"""Registered queries that SQL can express, over whole tables."""

import pytest

from tests.oracle import compare, duck
from tidegate.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert compare(spark, duck(sf_dir), sf_dir, QUERIES[name], ORACLES[name]) is None
