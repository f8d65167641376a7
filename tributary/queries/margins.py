"""Margin figures per client, with cost and revenue taken from order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import margin, rules
from . import query, table

COST_FACTOR = 2
SUMS = "decimal(38,4)"


def clients(spark: SparkSession, sf: str) -> DataFrame:
    """``id, cliente, regiao, uf, grupo, receita, custo`` per customer that has order lines.

    Lines are reduced to one row per order, with partial sums before the shuffle, before they meet
    the orders. Parts are joined without a hint, so Spark broadcasts them only below its own size
    limit and otherwise splits skewed part keys at run time. Nations and regions are the only
    tables whose size does not grow.
    """
    money = "decimal(18,2)"
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_quantity").cast(money).alias("quantity"),
        (F.col("l_extendedprice").cast(money) * (1 - F.col("l_discount").cast(money))).cast(SUMS).alias("revenue"),
    )
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").cast(money).alias("price")
    )
    per_order = (
        lines.join(parts, "l_partkey")
        .groupBy("l_orderkey")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum((COST_FACTOR * F.col("quantity") * F.col("price")).cast(SUMS)).alias("cost"),
        )
    )
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    per_client = (
        per_order.join(orders, "l_orderkey")
        .groupBy("o_custkey")
        .agg(F.sum("revenue").cast(SUMS).alias("receita"), F.sum("cost").cast(SUMS).alias("custo"))
    )
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return per_client.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("cliente"),
        F.col("r_name").alias("regiao"),
        F.col("n_name").alias("uf"),
        F.col("c_mktsegment").alias("grupo"),
        "receita",
        "custo",
    )


CLIENTS_SQL = """
    lines AS (
      SELECT o_custkey,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(38,4)) AS revenue,
        CAST(2 * CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(38,4)) AS cost
      FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
    ),
    clients AS (
      SELECT c_custkey AS id, c_name AS cliente, r_name AS regiao, n_name AS uf, c_mktsegment AS grupo,
        CAST(sum(revenue) AS DECIMAL(38,4)) AS receita, CAST(sum(cost) AS DECIMAL(38,4)) AS custo
      FROM lines JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey
      GROUP BY ALL
    ),
    rated AS (
      SELECT *, CASE WHEN receita <> 0 THEN (CAST(receita AS DOUBLE) - CAST(custo AS DOUBLE)) / CAST(receita AS DOUBLE) * 100
        ELSE 0.0 END AS margem FROM clients
    )
"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


@query(
    f"""
    WITH {CLIENTS_SQL}, totals AS (
      SELECT CAST(sum(receita) AS DECIMAL(38,4)) AS receita, CAST(sum(custo) AS DECIMAL(38,4)) AS custo, CAST(count_if(margem < 0) AS BIGINT) AS negativos FROM rated)
    SELECT receita, custo, round((CAST(receita AS DOUBLE) - CAST(custo AS DOUBLE)) / CAST(receita AS DOUBLE) * 100, 4) AS margem_media,
      CAST(receita - custo AS DECIMAL(38,4)) AS dif_custos, negativos FROM totals
    """
)
def kpi_totals(spark, sf):
    totals = _rounded(margin.kpis(clients(spark, sf)), "margem_media")
    return totals.withColumns({c: F.col(c).cast(SUMS) for c in ("receita", "custo", "dif_custos")})


@query(
    f"WITH {CLIENTS_SQL} SELECT id, cliente, regiao, grupo, receita, round(margem, 4) AS margem FROM rated "
    "ORDER BY rated.margem DESC, id LIMIT 5"
)
def top_clients(spark, sf):
    return _rounded(margin.top_clients(clients(spark, sf)), "margem").select(
        "id", "cliente", "regiao", "grupo", "receita", "margem"
    )


def _dimension_sql(column: str) -> str:
    return f"""
    WITH {CLIENTS_SQL}
    SELECT {column}, CAST(sum(receita) AS DECIMAL(38,4)) AS receita, CAST(sum(custo) AS DECIMAL(38,4)) AS custo, count(*) AS clientes,
      round((CAST(sum(receita) AS DOUBLE) - CAST(sum(custo) AS DOUBLE)) / CAST(sum(receita) AS DOUBLE) * 100, 4) AS margem
    FROM clients GROUP BY 1
    """


def _dimension(spark: SparkSession, sf: str, column: str) -> DataFrame:
    rows = _rounded(margin.by_dimension(clients(spark, sf), column), "margem")
    return rows.withColumns({c: F.col(c).cast(SUMS) for c in ("receita", "custo")})


@query(_dimension_sql("regiao"))
def margin_by_region(spark, sf):
    return _dimension(spark, sf, "regiao")


@query(_dimension_sql("uf"))
def margin_by_nation(spark, sf):
    return _dimension(spark, sf, "uf")


@query(_dimension_sql("grupo"))
def margin_by_segment(spark, sf):
    return _dimension(spark, sf, "grupo")


@query(
    f"""
    WITH {CLIENTS_SQL}
    SELECT grupo, CAST(sum(receita) AS DECIMAL(38,4)) AS receita,
      round(CAST(sum(receita) AS DOUBLE) / (SELECT CAST(sum(receita) AS DOUBLE) FROM clients) * 100, 4) AS participacao
    FROM clients GROUP BY 1
    """
)
def group_share(spark, sf):
    rows = _rounded(margin.share(clients(spark, sf), "grupo"), "participacao")
    return rows.withColumn("receita", F.col("receita").cast(SUMS))


_DIMENSIONS = ["regiao", "uf", "grupo"]


@query(
    f"WITH {CLIENTS_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{d}' AS dimensao, {d} AS entrada, CAST(sum(receita) AS DECIMAL(38,4)) AS receita, CAST(sum(custo) AS DECIMAL(38,4)) AS custo,
        count(*) AS clientes, round((CAST(sum(receita) AS DOUBLE) - CAST(sum(custo) AS DOUBLE)) / CAST(sum(receita) AS DOUBLE) * 100, 4) AS margem,
        round(CAST(sum(receita) AS DOUBLE) / (SELECT CAST(sum(receita) AS DOUBLE) FROM clients) * 100, 4) AS participacao
        FROM clients GROUP BY {d}"""
        for d in _DIMENSIONS
    )
)
def margin_by_all(spark, sf):
    """Region, state and group in one pass over the clients, each entry with its margin and share."""
    rows = _rounded(margin.by_dimensions(clients(spark, sf), _DIMENSIONS), "margem", "participacao")
    return rows.withColumns({c: F.col(c).cast(SUMS) for c in ("receita", "custo")})


_BAND_SQL = (
    "CASE WHEN margem > 10 THEN 'high' WHEN margem >= 5 THEN 'fair' WHEN margem >= 0 THEN 'low' ELSE 'negative' END"
)


@query(f"WITH {CLIENTS_SQL} SELECT {_BAND_SQL} AS faixa, count(*) AS clientes FROM rated GROUP BY 1")
def margin_band(spark, sf):
    rated = margin.with_margin(clients(spark, sf))
    return rated.groupBy(margin.band(F.col("margem")).alias("faixa")).agg(F.count(F.lit(1)).alias("clientes"))


@query(
    f"""
    WITH {CLIENTS_SQL}
    SELECT id, cliente, regiao, CAST(receita AS DECIMAL(38,4)) AS receita,
      'R$' || chr(160) || translate(format('{{:,.2f}}', CAST(CAST(receita AS DECIMAL(38,2)) AS DOUBLE)), ',.', '.,') AS receita_texto,
      round(margem, 1) + 0.0 AS margem, {_BAND_SQL} AS faixa
    FROM rated
    """
)
def detail_table(spark, sf):
    rows = clients(spark, sf)
    detail = margin.detail_table(rows)
    return detail


@query("SELECT r_name AS regiao FROM region WHERE EXISTS (SELECT 1 FROM nation JOIN customer ON c_nationkey = n_nationkey "
       "JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE n_regionkey = r_regionkey)")
def region_values(spark, sf):
    return margin.dimension_values(clients(spark, sf), "regiao")


@query(f"WITH {CLIENTS_SQL} SELECT id, cliente, regiao, receita FROM clients WHERE regiao = 'EUROPE'")
def region_filter(spark, sf):
    return rules.in_region(clients(spark, sf), "EUROPE").select("id", "cliente", "regiao", "receita")


@query(f"WITH {CLIENTS_SQL} SELECT id, receita FROM clients")
def region_filter_all(spark, sf):
    return rules.in_region(clients(spark, sf), rules.ALL_REGIONS).select("id", "receita")


@query(f"WITH {CLIENTS_SQL} SELECT id, round(CAST(custo AS DOUBLE), 2) AS custo FROM clients")
def cost_identity(spark, sf):
    """Cost recomputed from revenue and margin."""
    rated = margin.with_margin(clients(spark, sf))
    cost = margin.cost_from_margin(F.col("receita").cast("double"), F.col("margem"))
    return rated.select("id", F.round(cost, 2).alias("custo"))
