"""Every registered query against the same result computed by DuckDB."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import TABLES

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")


def plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def rows_of(table):
    names = sorted(table.column_names)
    columns = [[plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns))


OWN = [n for n in contract.queries() if n not in contract._training_data()[0]]


def test_every_query_has_an_equivalent():
    assert set(OWN) <= set(contract.oracle_sql())


def test_entry(spark, sf):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query(spark, sf, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    expected = rows_of(connection.sql(contract.oracle_sql()[name]).to_arrow_table())
    actual = rows_of(contract.queries()[name](spark, sf).toArrow())
    assert actual[0] == expected[0]
    assert actual[1] == expected[1]
