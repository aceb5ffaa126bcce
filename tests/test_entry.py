import pytest

from conftest import SF_SMALL


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns[0] == "analysis_date" and "estimated_completion_date" in df.columns


def test_every_query_has_an_oracle():
    from lodestar.plans.catalog import QUERIES
    from __spark_entry__ import oracle_sql, queries
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) == set(oracle_sql()) & set(QUERIES)


def _names():
    from lodestar.plans.catalog import QUERIES
    return list(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    from oracle_compare import compare
    ok, msg = compare(spark, name, SF_SMALL)
    assert ok, msg
