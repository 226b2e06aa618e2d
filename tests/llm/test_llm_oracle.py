"""Queries against their DuckDB statements."""

import pytest

import oracle_check
from tunestats.llm import registry


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, name):
    res = oracle_check.compare(spark, "/root/testdata/sf0.01", [name])[name]
    assert res["values"] and res["rows"] and res["types"], res
