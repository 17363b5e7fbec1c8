"""Operators that SQL can express, against DuckDB over the same tables."""

import pytest

from checks.compare import oracle_connection
from faremill.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_equals_sql(spark, small, name):
    found = queries.QUERIES[name](spark, small)
    result = oracle_connection(small).sql(oracle.ORACLE[name])
    assert sorted(result.columns) == sorted(found.columns)
    expected = result.select(", ".join(f'"{c}"' for c in found.columns)).fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
