"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..plans.work import CHECKPOINT_SETTING, remove_folder, work_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_BLANKS = r"[\x20\x09-\x0D]+"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other letter alone."""
    return F.translate(text, UPPER, UPPER.lower())


def arrow_fields(df: DataFrame, names: tuple[str, ...]) -> list[tuple[str, pa.DataType]]:
    return [(name, to_arrow_type(df.schema[name].dataType)) for name in names]


def described(df: DataFrame, names: tuple[str, ...]) -> str:
    """The columns as the text of a schema."""
    return ", ".join(f"`{name}` {df.schema[name].dataType.simpleString()}" for name in names)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the cluster, else one in the warehouse.

    A warehouse in a local folder is one of the driver alone, so on a cluster it is refused.
    """
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    folder = work_folder(spark, warehouse)
    local = folder.startswith(warehouse.rstrip("/")) and urlparse(warehouse).scheme in ("", "file")
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share, {folder} is local")
    return folder


#: Tables written by this session.
_STORED: list[str] = []


def remove_stored(spark: SparkSession) -> None:
    """Removes all tables that operators of this session wrote between steps; results not yet written are lost."""
    while _STORED:
        remove_folder(spark, _STORED.pop())


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, order: list[str], sums: dict[str, str], tasks: int) -> DataFrame:
    """Adds running totals over a total order without bringing all rows into one task.

    ``order`` must be unique. ``sums`` maps each new column to the numeric column that it sums, the
    row itself included. Rows are range-partitioned; each part sums its own rows and adds the totals
    of the parts before it, a table of one row per part.
    """
    part = stored(
        rows.repartitionByRange(tasks, *order).withColumn("_part", F.spark_partition_id()), "parts"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = part.groupBy("_part").agg(*(F.sum(column).alias(f"_{new}") for new, column in sums.items()))
    starts = totals.select(
        "_part", *(F.coalesce(F.sum(f"_{new}").over(before), F.lit(0)).alias(f"_{new}") for new in sums)
    )
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        part.select("*", *(F.sum(column).over(within).alias(new) for new, column in sums.items()))
        .join(starts, "_part")
        .select(*rows.columns, *((F.col(new) + F.col(f"_{new}")).alias(new) for new in sums))
    )


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``links(a, b)``: rows ``(node, root)``, root being the smallest node.

    Alternates large-star and small-star steps until no link changes. Minima are partial aggregates;
    the joins carry links, never neighbour lists, so a node with very many links is split by Spark.
    """
    current = stored(_ordered(links), "links")
    before = _state(current)
    for _ in range(rounds):
        current = stored(_small_star(_large_star(current)), "links")
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    children = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return children.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, the larger node first, none from a node to itself."""
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    moved = both.where(F.col("b") > F.col("a")).join(lowest, "a")
    return _ordered(moved.select(F.col("b").alias("a"), F.col("low").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    lowest = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return _ordered(moved.unionByName(lowest.select("a", F.col("low").alias("b"))))
