"""Compaction of months: union, keep-latest, statistics, stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.compact import concat_parts, keep_latest, keep_latest_narrow, keep_statistics, merge_months
from ..plans.flat_tables import months_to_flatten, stale_months
from ..plans.work import work_folder
from ..sinks import versions
from ..sinks.monthly import read_months, write_months
from . import query, table

LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER_SQL = (
    "l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST"
)


def scratch(spark: SparkSession, name: str) -> str:
    """New folder for a table that a query writes: the cluster's shared one, else in the warehouse."""
    return f"{work_folder(spark, spark.conf.get('spark.sql.warehouse.dir'))}/{name}-{uuid.uuid4().hex}"


@query(
    f"""
    SELECT * FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) = 1
    """
)
def dedupe_latest(spark, sf):
    return keep_latest(table(spark, sf, "lineitem"), LINE_KEY, scope=[], newest_first=LINE_ORDER)


@query(
    """
    SELECT l_returnflag, l_orderkey, max(l_shipdate) AS l_shipdate FROM (
      SELECT l_returnflag, CASE WHEN l_linenumber > 1 THEN l_orderkey END AS l_orderkey, l_shipdate FROM lineitem
    ) WHERE l_orderkey IS NOT NULL GROUP BY ALL
    """
)
def dedupe_latest_narrow(spark, sf):
    """Keep-latest inside a scope by aggregation, rows without a key being dropped."""
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", F.when(F.col("l_linenumber") > 1, F.col("l_orderkey")).alias("l_orderkey"), "l_shipdate"
    )
    return keep_latest_narrow(rows, "l_orderkey", scope=["l_returnflag"], newest_first=["l_shipdate"])


@query(
    f"""
    SELECT o_orderpriority, o_orderstatus, o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS d, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END AS key
      FROM orders) WHERE key IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority, key ORDER BY d DESC NULLS LAST, o_orderkey DESC) = 1
    """
)
def dedupe_null_order(spark, sf):
    """Rows whose order column is NULL count as oldest; rows without a key are dropped."""
    rows = table(spark, sf, "orders").withColumns(
        {
            "d": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")),
            "key": F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")),
        }
    )
    return keep_latest(rows, "key", scope=["o_orderpriority"], newest_first=["d", "o_orderkey"]).select(
        "o_orderpriority", "o_orderstatus", "o_custkey", "o_orderkey", "o_totalprice"
    )


@query(
    """
    SELECT l_returnflag AS source, strftime(l_shipdate, '%Y%m') AS ref_aaaamm, count(*) AS rows_before,
      count(DISTINCT key) AS rows_after, count(*) - count(key) AS null_keys, count(key) - count(DISTINCT key) AS dupes_removed
    FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_partkey END AS key FROM lineitem)
    GROUP BY 1, 2
    """
)
def dedupe_stats(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("source"),
        F.date_format("l_shipdate", "yyyyMM").alias("ref_aaaamm"),
        F.when(F.col("l_linenumber") != 1, F.col("l_partkey")).alias("key"),
    )
    return keep_statistics(rows, "key").select(
        "source", "ref_aaaamm", "rows_before", "rows_after",
        F.col("null_keys").cast("bigint").alias("null_keys"),
        F.col("dupes_removed").cast("bigint").alias("dupes_removed"),
    )


@query(
    f"""
    WITH a AS (SELECT * FROM lineitem WHERE l_quantity <= 30), b AS (SELECT * FROM lineitem WHERE l_quantity >= 20)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate
    FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) = 1
    """
)
def concat_parts_latest(spark, sf):
    """Two overlapping parts, put together and deduplicated."""
    lines = table(spark, sf, "lineitem")
    both = concat_parts(lines.filter("l_quantity <= 30"), lines.filter("l_quantity >= 20"))
    return keep_latest(both, LINE_KEY, scope=[], newest_first=LINE_ORDER).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )


@query(
    "SELECT l_returnflag, count(*) AS n FROM (SELECT l_returnflag FROM lineitem UNION ALL "
    "SELECT l_returnflag FROM lineitem WHERE l_quantity > 10) GROUP BY 1"
)
def concat_keeps_copies(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity")
    return concat_parts(lines, lines.filter("l_quantity > 10")).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n")
    )


def _order_rows(spark: SparkSession, sf: str, version: int, condition: str) -> DataFrame:
    return table(spark, sf, "orders").filter(condition).select(
        F.col("o_orderkey").alias("key"),
        F.lit(version).alias("version"),
        F.lit("orders").alias("source"),
        F.date_format("o_orderdate", "yyyyMM").alias("ref_aaaamm"),
    )


# Together all orders; some of them in both.
_SECOND = "o_orderkey % 2 = 0 and month(o_orderdate) <= 6"
_FIRST = "(o_orderkey % 3 <> 0 or o_orderkey % 2 = 1 or month(o_orderdate) > 6)"


def _stored_twice(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    path = scratch(spark, f"months-{mode}")
    write_months(_order_rows(spark, sf, 1, _FIRST), path, sort_by="key")
    new = _order_rows(spark, sf, 2, _SECOND)
    schema = new.schema
    if mode == "merge":
        months = [r[0] for r in new.select("ref_aaaamm").distinct().collect()]
        stored = read_months(spark, path, schema, months)
        new = merge_months(stored, new, "key", newest_first=["version"])
    write_months(new, path, sort_by="key")
    return read_months(spark, path, schema).select("key", "version", "ref_aaaamm")


@query(
    f"""
    WITH a AS (SELECT *, strftime(o_orderdate, '%Y%m') AS m FROM orders WHERE {_FIRST}),
      b AS (SELECT *, strftime(o_orderdate, '%Y%m') AS m FROM orders WHERE {_SECOND})
    SELECT o_orderkey AS key, 2 AS version, m AS ref_aaaamm FROM b
    UNION ALL SELECT o_orderkey, 1, m FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
    """
)
def month_merge(spark, sf):
    """Months written, then written again with new rows merged into the stored ones."""
    return _stored_twice(spark, sf, "merge")


@query(
    f"""
    WITH a AS (SELECT *, strftime(o_orderdate, '%Y%m') AS m FROM orders WHERE {_FIRST}),
      b AS (SELECT *, strftime(o_orderdate, '%Y%m') AS m FROM orders WHERE {_SECOND})
    SELECT o_orderkey AS key, 2 AS version, m AS ref_aaaamm FROM b
    UNION ALL SELECT o_orderkey, 1, m FROM a WHERE m NOT IN (SELECT m FROM b)
    """
)
def month_replace(spark, sf):
    """Months written, then replaced by the new rows; other months stay."""
    return _stored_twice(spark, sf, "replace")


@query(
    """SELECT strftime(o_orderdate, '%Y%m') AS ref_aaaamm, count(*) AS n FROM orders
       WHERE strftime(o_orderdate, '%Y%m') IN ('199801', '199712') GROUP BY 1"""
)
def month_pruning(spark, sf):
    """A stored table read for two months only."""
    path = scratch(spark, "pruning")
    write_months(_order_rows(spark, sf, 1, "true"), path)
    stored = read_months(spark, path, None, ["199801", "199712"])
    return stored.groupBy("ref_aaaamm").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    WITH s AS (SELECT strftime(o_orderdate, '%Y%m') AS m, max(o_orderdate) AS t FROM orders GROUP BY 1),
      f AS (SELECT strftime(l_shipdate, '%Y%m') AS m, max(l_shipdate - INTERVAL 1 DAY * (month(l_shipdate) % 2)) AS t FROM lineitem GROUP BY 1)
    SELECT s.m AS ref_aaaamm FROM s LEFT JOIN f ON f.m = s.m WHERE f.t IS NULL OR f.t < s.t
    """
)
def stale_months_by_time(spark, sf):
    """Months whose copy is missing or older, on file times taken from order and ship dates.

    Copies of odd months are a day old.
    """
    source = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("ref_aaaamm"), F.col("o_orderdate").alias("modificationTime")
    )
    flat = table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyyMM").alias("ref_aaaamm"),
        F.expr("l_shipdate - make_dt_interval(month(l_shipdate) % 2)").alias("modificationTime"),
    )
    return stale_months(source, flat)


@query(
    """
    SELECT strftime(o_orderdate, '%Y%m') AS ref_aaaamm, year(o_orderdate) >= 1997 AS stale FROM orders GROUP BY ALL
    """
)
def stale_months_stored(spark, sf):
    """The same decision on stored tables: the copy lacks the last years."""
    path = scratch(spark, "stale")
    rows = _order_rows(spark, sf, 1, "true")
    write_months(rows, path)
    write_months(rows.filter("ref_aaaamm < '1997'"), path + "_flat")
    window = [row[0] for row in rows.select("ref_aaaamm").distinct().collect()]
    stale = months_to_flatten(spark, path, window)
    return read_months(spark, path, None).select(
        "ref_aaaamm", F.col("ref_aaaamm").isin(stale).alias("stale")
    ).distinct()


def _merged(spark: SparkSession, rows: DataFrame, path: str, mode: str = "merge") -> int:
    new = versions.located(rows, scratch(spark, "new-rows"))
    return versions.merge_version(
        spark, path, new, key="key", schema=rows.schema, work=scratch(spark, "losers"), mode=mode, newest_first=["version"]
    )


@query(
    f"""
    WITH a AS (SELECT *, strftime(o_orderdate, '%Y%m') AS m FROM orders WHERE {_FIRST}),
      b AS (SELECT *, strftime(o_orderdate, '%Y%m') AS m FROM orders WHERE {_SECOND}),
      merged AS (SELECT o_orderkey, 2 AS version, m FROM b
        UNION ALL SELECT o_orderkey, 1, m FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b))
    SELECT 'before' AS reader, o_orderkey AS key, 1 AS version, m AS ref_aaaamm FROM a
    UNION ALL SELECT 'between', o_orderkey, version, m FROM merged
    UNION ALL SELECT 'after', o_orderkey, CASE WHEN m = '199501' THEN 3 ELSE version END, m FROM merged
      WHERE m <> '199501' OR o_orderkey % 5 = 0
    UNION ALL SELECT 'after', o_orderkey, 3, m FROM a WHERE m = '199501' AND o_orderkey % 5 = 0 AND o_orderkey NOT IN (SELECT o_orderkey FROM merged)
    """
)
def month_versions(spark, sf):
    """Readers that open a table between writes: each sees one whole version, also after later ones.

    The second version merges rows, the third replaces a month. A fourth writes its data and stops.
    """
    path = scratch(spark, "versions")
    _merged(spark, _order_rows(spark, sf, 1, _FIRST), path)
    schema = _order_rows(spark, sf, 1, _FIRST).schema
    opened = read_months(spark, path, schema)
    _merged(spark, _order_rows(spark, sf, 2, _SECOND), path)
    readers = {"between": read_months(spark, path, schema)}
    third = _order_rows(spark, sf, 3, "o_orderkey % 5 = 0").where("ref_aaaamm = '199501'")
    # Two versions stay readable, so what the first reader sees is kept before the third is written.
    readers["before"] = versions.located(opened, scratch(spark, "opened"))
    _merged(spark, third, path, mode="replace")
    stopped = _order_rows(spark, sf, 4, "true").withColumn(versions.BUCKET, F.lit(0))
    versions.write_buckets(stopped, path, versions.new_label(versions.current_version(spark, path)), "key")
    readers["after"] = read_months(spark, path, schema)
    found = None
    for name, rows in readers.items():
        rows = rows.select(F.lit(name).alias("reader"), "key", "version", "ref_aaaamm")
        found = rows if found is None else found.union(rows)
    return found


@query("SELECT strftime(o_orderdate, '%Y%m') AS ref_aaaamm, count(*) AS n, 0 AS unsorted FROM orders GROUP BY 1")
def month_sorted(spark, sf):
    """Rows of each stored file follow one another by key, in plain months and in versions."""
    plain, versioned = scratch(spark, "sorted"), scratch(spark, "sorted-versions")
    rows = _order_rows(spark, sf, 1, "true")
    write_months(rows.where("key % 2 = 0"), plain, sort_by="key")
    _merged(spark, rows.where("key % 2 = 1"), versioned)
    entries = versions.entries_of(spark, versioned)
    stored = spark.read.option("basePath", plain).parquet(plain).select("key", F.col("ref_aaaamm").cast("string").alias("ref_aaaamm"), *versions.positions())
    stored = stored.unionByName(
        versions.read_entries(spark, versioned, entries, rows.schema, (versions.FILE, versions.ROW)).select(*stored.columns)
    )
    before = F.lag("key").over(Window.partitionBy(versions.FILE).orderBy(versions.ROW))
    marked = stored.withColumn("falls", F.coalesce(before > F.col("key"), F.lit(False)))
    return marked.groupBy("ref_aaaamm").agg(F.count(F.lit(1)).alias("n"), F.count_if("falls").cast("int").alias("unsorted"))


@query(
    """
    SELECT strftime(o_orderdate, '%Y%m') AS ref_aaaamm, o_orderkey AS key,
      CASE WHEN year(o_orderdate) >= 1997 THEN o_custkey END AS client, CASE WHEN year(o_orderdate) < 1997 THEN o_orderpriority END AS priority,
      CASE WHEN year(o_orderdate) < 1997 THEN 'plain' ELSE 'version' END AS kind
    FROM orders
    """
)
def months_of_different_columns(spark, sf):
    """Months written with other columns than later ones: a table that describes itself has those of all.

    The early months are plain folders, which became part of the first version of the table.
    """
    path = scratch(spark, "columns")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("client"), F.col("o_orderpriority").alias("priority"),
        F.lit(1).alias("version"), F.lit("orders").alias("source"), F.date_format("o_orderdate", "yyyyMM").alias("ref_aaaamm"),
    )
    write_months(orders.where("ref_aaaamm < '1997'").drop("client").withColumn("kind", F.lit("plain")), path, sort_by="key")
    _merged(spark, orders.where("ref_aaaamm >= '1997'").drop("priority").withColumn("kind", F.lit("version")), path)
    return read_months(spark, path, None).select("ref_aaaamm", "key", "client", "priority", "kind")
