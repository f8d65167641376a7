"""Queries that SQL can express, against DuckDB."""

import pytest
from compare import expected, rows_of

from tributary.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert rows_of(QUERIES[name](spark, sf).toArrow()) == expected(sf, ORACLES[name])
