"""The queries that SQL can express, against DuckDB on the same tables."""

import pytest

from lodestar.llm.oracle import ORACLE_SQL
from tests.oracle_compare import compare, duck, type_mismatches

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duck(SF)
    ok, message = compare(spark, name, SF, con)
    assert ok, message
    assert type_mismatches(spark, name, SF, con) == []
