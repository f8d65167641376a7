"""Runs a query's SQL in DuckDB and compares values as text."""

import datetime as dt

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def rows_of(table):
    names = sorted(table.column_names)
    return names, sorted(zip(*([plain(v) for v in table.column(n).to_pylist()] for n in names)))


def expected(sf, sql, **tables):
    connection = duckdb.connect()
    for name in TABLES:
        if name in tables:
            connection.register(name, tables[name])
        elif sf:
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return rows_of(connection.sql(sql).to_arrow_table())
