"""Unnesting of lists that belong to one row."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.flatten import expansion, flatten, flatten_balanced, flatten_freight, flatten_invoices
from . import query, table


def _sequence(count: str, entry: str, type_: str) -> str:
    """Array with an entry per i = 1..count; NULL where the count is NULL."""
    return (
        f"transform(if({count} > 0, sequence(1, cast({count} as int)), cast(array() as array<int>)), "
        f"i -> cast({entry} as {type_}))"
    )


@query(
    """
    WITH parts AS (
      SELECT doc_id, lang, CASE WHEN lang = 'fr' THEN NULL ELSE string_split(text, chr(10)) END AS lines FROM documents
    )
    SELECT d.doc_id, d.lang, CAST(i AS SMALLINT) AS item_seq, lines[i] AS line,
      CAST(length(lines[i]) AS INTEGER) AS chars
    FROM parts d LEFT JOIN (
      SELECT doc_id, unnest(generate_series(1, len(lines))) AS i FROM parts
    ) p ON p.doc_id = d.doc_id
    """
)
def flatten_items(spark, sf):
    """Whole texts as lists of lines with their lengths; documents without a list keep one row."""
    lines = F.split("text", "\n", -1)
    nested = table(spark, sf, "documents").select(
        "doc_id", "lang", F.when(F.col("lang") != "fr", lines).alias("line")
    )
    nested = nested.withColumn("chars", F.transform("line", F.length))
    return flatten(nested, {"lines": ["line", "chars"]}, sequence_group="lines").select(
        "doc_id", "lang", "item_seq", "line", "chars"
    )


@query(
    """
    SELECT o.o_orderkey, CAST(i AS SMALLINT) AS item_seq, 'P' || CAST(o_custkey + i AS VARCHAR) AS "itens_cProd",
      CAST(i * 2 AS DECIMAL(38,12)) AS "itens_qCom",
      lpad(CAST(d AS VARCHAR), 3, '0') AS "dup_nDup", CAST(o_orderdate AS DATE) + CAST(d AS INTEGER) AS "dup_dVenc",
      CAST(p AS VARCHAR) AS "pag_tPag", 'w' || CAST(w AS VARCHAR) AS parser_warnings
    FROM orders o
      LEFT JOIN (SELECT o_orderkey, unnest(generate_series(1, o_orderkey % 4)) AS i FROM orders) a ON a.o_orderkey = o.o_orderkey
      LEFT JOIN (SELECT o_orderkey, unnest(generate_series(1, o_custkey % 3)) AS d FROM orders) b ON b.o_orderkey = o.o_orderkey
      LEFT JOIN (SELECT o_orderkey, unnest(generate_series(1, o_orderkey % 3)) AS p FROM orders) c ON c.o_orderkey = o.o_orderkey
      LEFT JOIN (SELECT o_orderkey, unnest(generate_series(1, o_custkey % 2)) AS w FROM orders) e ON e.o_orderkey = o.o_orderkey
    """
)
def flatten_product(spark, sf):
    """Items x instalments x payments x warnings."""
    nested = table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr(_sequence("o_orderkey % 4", "concat('P', o_custkey + i)", "string")).alias("itens_cProd"),
        F.expr(_sequence("o_orderkey % 4", "i * 2", "decimal(38,12)")).alias("itens_qCom"),
        F.expr(_sequence("o_custkey % 3", "lpad(cast(i as string), 3, '0')", "string")).alias("dup_nDup"),
        F.expr(_sequence("o_custkey % 3", "date_add(cast(o_orderdate as date), i)", "date")).alias("dup_dVenc"),
        F.expr(f"if(o_orderkey % 3 = 0, null, {_sequence('o_orderkey % 3', 'i', 'string')})").alias("pag_tPag"),
        F.expr(f"if(o_custkey % 2 = 0, null, {_sequence('1', 'concat(cast(chr(119) as string), i)', 'string')})").alias("parser_warnings"),
    )
    return flatten_invoices(nested)


@query(
    """
    WITH lists AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 4 AS na, l_partkey % 3 AS nb, l_suppkey % 2 AS nc
      FROM lineitem
    )
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(i AS SMALLINT) AS item_seq,
      CASE WHEN i <= na THEN CAST(l_partkey + i AS BIGINT) END AS a,
      CASE WHEN i <= nb THEN CAST(l_suppkey * i AS BIGINT) END AS b,
      CASE WHEN i <= nc THEN 'c' || CAST(i AS VARCHAR) END AS c
    FROM lists, LATERAL (SELECT unnest(CASE WHEN greatest(na, nb, nc) = 0 THEN [NULL]
        ELSE generate_series(1, greatest(na, nb, nc)) END) AS i)
    """
)
def flatten_uneven(spark, sf):
    """Lists of different length in one group, some of them NULL."""
    nested = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.expr(_sequence("l_linenumber % 4", "l_partkey + i", "bigint")).alias("a"),
        F.expr(f"if(l_partkey % 3 = 0, null, {_sequence('l_partkey % 3', 'l_suppkey * i', 'bigint')})").alias("b"),
        F.expr(_sequence("l_suppkey % 2", "concat(cast(chr(99) as string), i)", "string")).alias("c"),
    )
    return flatten(nested, {"g": ["a", "b", "c", "absent"]}, sequence_group="g").select(
        "l_orderkey", "l_linenumber", "l_partkey", "item_seq", "a", "b", "c"
    )


@query(
    """
    SELECT k.p_partkey, CAST(q * 1.5 AS DECIMAL(38,12)) AS "infQ_qCarga", p_name || CAST(n AS VARCHAR) AS "infNFe_chave",
      CAST(v AS DECIMAL(38,12)) AS "transp_qVol", CAST(NULL AS VARCHAR) AS parser_warnings
    FROM part k
      LEFT JOIN (SELECT p_partkey, unnest(generate_series(1, p_size % 4)) AS q FROM part) a ON a.p_partkey = k.p_partkey
      LEFT JOIN (SELECT p_partkey, unnest(generate_series(1, p_partkey % 3)) AS n FROM part) b ON b.p_partkey = k.p_partkey
      LEFT JOIN (SELECT p_partkey, unnest(generate_series(1, p_size % 3)) AS v FROM part) c ON c.p_partkey = k.p_partkey
    """
)
def flatten_freight_groups(spark, sf):
    """Four independent groups, one of them always NULL."""
    nested = table(spark, sf, "part").select(
        "p_partkey",
        F.expr(_sequence("p_size % 4", "i * 1.5", "decimal(38,12)")).alias("infQ_qCarga"),
        F.expr(_sequence("p_partkey % 3", "concat(p_name, i)", "string")).alias("infNFe_chave"),
        F.expr(_sequence("p_size % 3", "i", "decimal(38,12)")).alias("transp_qVol"),
        F.lit(None).cast("array<string>").alias("parser_warnings"),
    )
    return flatten_freight(nested)


@query(
    """
    SELECT strftime(o_orderdate, '%Y%m') AS ref_aaaamm, count(*) AS rows_in,
      CAST(sum(greatest(o_orderkey % 4, 1) * greatest(o_custkey % 3, 1)) AS BIGINT) AS rows_out
    FROM orders GROUP BY 1
    """
)
def flatten_expansion(spark, sf):
    """How many rows flattening will give per month, without flattening."""
    nested = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("ref_aaaamm"),
        F.expr(_sequence("o_orderkey % 4", "i", "int")).alias("a"),
        F.expr(_sequence("o_custkey % 3", "i", "int")).alias("b"),
    )
    return expansion(nested, {"a": ["a"], "b": ["b"]}, ["ref_aaaamm"])


@query("SELECT CAST(count(*) FILTER (WHERE o_orderkey < 0) AS BIGINT) AS n, 3 AS n_columns FROM orders")
def flatten_empty(spark, sf):
    """Nothing in, nothing out, with the flat schema."""
    nested = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(_sequence("o_orderkey % 4", "i", "int")).alias("a")
    )
    flat = flatten(nested.filter("o_orderkey < 0"), {"a": ["a"]}, sequence_group="a")
    return flat.agg(F.count(F.lit(1)).alias("n"), F.lit(len(flat.columns)).alias("n_columns"))


@query(
    """
    SELECT o.o_orderkey, CAST(i AS SMALLINT) AS item_seq, 'P' || CAST(o_custkey + i AS VARCHAR) AS item,
      CASE WHEN i % 2 = 1 AND i <= 5 THEN CAST(i AS INTEGER) END AS amount, CAST(d AS INTEGER) AS due, CAST(p AS VARCHAR) AS pay
    FROM orders o
      LEFT JOIN (SELECT o_orderkey, unnest(generate_series(1, o_orderkey % 23)) AS i FROM orders) a ON a.o_orderkey = o.o_orderkey
      LEFT JOIN (SELECT o_orderkey, unnest(generate_series(1, o_custkey % 5)) AS d FROM orders) b ON b.o_orderkey = o.o_orderkey
      LEFT JOIN (SELECT o_orderkey, unnest(generate_series(1, o_orderkey % 3)) AS p FROM orders) c ON c.o_orderkey = o.o_orderkey
    """
)
def flatten_shared(spark, sf):
    """Products of lists, those of more than twenty rows cut along their widest list and shared by tasks."""
    nested = table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr(_sequence("o_orderkey % 23", "concat('P', o_custkey + i)", "string")).alias("item"),
        F.expr(_sequence("least(o_orderkey % 23, 5)", "if(i % 2 = 1, i, null)", "int")).alias("amount"),
        F.expr(f"if(o_custkey % 5 = 0, null, {_sequence('o_custkey % 5', 'i', 'int')})").alias("due"),
        F.expr(_sequence("o_orderkey % 3", "i", "string")).alias("pay"),
    )
    groups = {"items": ["item", "amount"], "dues": ["due"], "pays": ["pay"]}
    return flatten_balanced(nested, groups, sequence_group="items", most=20)
