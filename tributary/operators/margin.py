"""Margin figures over client rows ``cliente, regiao, uf, grupo, receita, custo``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import rules

# Lower bounds of the margin bands, in percent, and the names used for them here.
BAND_ABOVE, BAND_FROM, BAND_ZERO = 10, 5, 0
BANDS = ("high", "fair", "low", "negative")
TOP_CLIENTS = 5


def margin(revenue: Column, cost: Column) -> Column:
    """Margin in percent of revenue, 0 when there is no revenue."""
    r, c = revenue.cast("double"), cost.cast("double")
    return F.when(r != 0, (r - c) / r * 100).otherwise(F.lit(0.0))


def cost_from_margin(revenue: Column, percent: Column) -> Column:
    """Cost that goes with a revenue and a margin in percent."""
    return revenue * (1 - percent / 100)


def band(percent: Column) -> Column:
    """Band of a margin: above 10, from 5, from 0, below 0."""
    return (
        F.when(percent > BAND_ABOVE, F.lit(BANDS[0]))
        .when(percent >= BAND_FROM, F.lit(BANDS[1]))
        .when(percent >= BAND_ZERO, F.lit(BANDS[2]))
        .otherwise(F.lit(BANDS[3]))
    )


def with_margin(clients: DataFrame) -> DataFrame:
    return clients.withColumn("margem", margin(F.col("receita"), F.col("custo")))


def kpis(clients: DataFrame) -> DataFrame:
    """Revenue, cost, weighted margin, cost difference and number of clients with a loss."""
    totals = with_margin(clients).agg(
        F.sum("receita").alias("receita"),
        F.sum("custo").alias("custo"),
        F.count_if(F.col("margem") < 0).alias("negativos"),
    )
    return totals.select(
        "receita",
        "custo",
        margin(F.coalesce("receita", F.lit(0)), F.coalesce("custo", F.lit(0))).alias("margem_media"),
        (F.col("receita") - F.col("custo")).alias("dif_custos"),
        "negativos",
    )


def top_clients(clients: DataFrame, n: int = TOP_CLIENTS) -> DataFrame:
    """Clients with the highest margin; equal margins are ordered by client id."""
    return with_margin(clients).orderBy(F.desc("margem"), F.asc("id")).limit(n)


def by_dimension(clients: DataFrame, dimension: str) -> DataFrame:
    """Weighted margin and totals per region, state or group."""
    return (
        clients.groupBy(dimension)
        .agg(
            F.sum("receita").alias("receita"),
            F.sum("custo").alias("custo"),
            F.count(F.lit(1)).alias("clientes"),
        )
        .withColumn("margem", margin(F.col("receita"), F.col("custo")))
    )


def share(clients: DataFrame, dimension: str) -> DataFrame:
    """Share of each entry of a dimension in total revenue, in percent."""
    grouped = clients.groupBy(dimension).agg(F.sum("receita").alias("receita"))
    # One row per entry is left, so that the total over all of them is small work.
    total = F.sum("receita").over(Window.partitionBy()).cast("double")
    revenue = F.col("receita").cast("double")
    return grouped.select(
        dimension,
        "receita",
        F.when(total != 0, revenue / total * 100).otherwise(F.lit(0.0)).alias("participacao"),
    )


def by_dimensions(clients: DataFrame, dimensions: list[str]) -> DataFrame:
    """Totals, weighted margin and share in revenue of every entry of several dimensions, in one pass.

    Rows ``(dimensao, entrada, receita, custo, clientes, margem, participacao)``. The clients are read and
    partially summed once for all dimensions.
    """
    summed = clients.groupingSets([[F.col(d)] for d in dimensions], *dimensions).agg(
        F.sum("receita").alias("receita"),
        F.sum("custo").alias("custo"),
        F.count(F.lit(1)).alias("clientes"),
        *[F.grouping(d).alias(f"_{d}") for d in dimensions],
    )
    dimension, entry = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in dimensions:
        own = F.col(f"_{name}") == 0
        dimension = F.when(own, name).otherwise(dimension)
        entry = F.when(own, F.col(name).cast("string")).otherwise(entry)
    named = summed.select(dimension.alias("dimensao"), entry.alias("entrada"), "receita", "custo", "clientes")
    # One row per entry is left, so that the totals over all of them are small work.
    total = F.sum("receita").over(Window.partitionBy("dimensao")).cast("double")
    return named.withColumn("margem", margin(F.col("receita"), F.col("custo"))).withColumn(
        "participacao", F.when(total != 0, F.col("receita").cast("double") / total * 100).otherwise(F.lit(0.0))
    )


def dimension_values(clients: DataFrame, dimension: str) -> DataFrame:
    """Distinct entries offered by a selector."""
    return clients.select(dimension).distinct()


def brazilian_number(value: Column, decimals: int) -> Column:
    """Number with ``.`` between thousands and ``,`` before the decimals."""
    return F.translate(F.format_number(F.round(value, decimals), decimals), ",.", ".,")


def brazilian_currency(value: Column) -> Column:
    """Amount as ``R$ 1.234,56``, the gap being a no-break space, the sign in front."""
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("R$\u00a0"), brazilian_number(F.abs(value), 2))


def detail_table(clients: DataFrame, region: str = rules.ALL_REGIONS) -> DataFrame:
    """Client, region, revenue, revenue as currency text, margin to one decimal and its band."""
    rows = with_margin(rules.in_region(clients, region))
    return rows.select(
        "id",
        "cliente",
        "regiao",
        "receita",
        brazilian_currency(F.col("receita")).alias("receita_texto"),
        (F.round("margem", 1) + F.lit(0.0)).alias("margem"),
        band(F.col("margem")).alias("faixa"),
    )
