"""Every registered query against its independent DuckDB statement."""

import pytest

import oracle_check
from conftest import SF_SMALL


@pytest.mark.parametrize("sf_dir", [SF_SMALL])
def test_all_queries_match_oracle(spark, sf_dir):
    import __spark_entry__ as E
    own = [k for k in E.oracle_sql() if not (E.llm and (k in E.llm.SQL or k == "pipeline"))]
    res = oracle_check.compare(spark, sf_dir, own)
    bad = {k: v for k, v in res.items() if not (v["values"] and v["rows"] and v["types"])}
    assert not bad, bad
    assert len(res) >= 38


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    own = {k for k in E.queries() if not (E.llm and (k in E.llm.QUERIES or k == "pipeline"))}
    assert own <= set(E.oracle_sql()) <= set(E.queries())
