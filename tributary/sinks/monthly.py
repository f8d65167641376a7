"""Month-partitioned Parquet: writing and reading back.

``write_months`` writes months as plain folders. Ingestion writes versions of months instead, see
``versions``; ``read_months`` reads either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import fields as X

# Codec and level of all stored tables.
CODEC, LEVEL = "zstd", "3"


def write_months(df: DataFrame, path: str, sort_by: str | None = None) -> None:
    """Replaces the months present in ``df`` and leaves all other months alone.

    Rows are rebalanced by month first: Spark splits a large month over tasks and puts small months
    together, so the files of a month depend on its size, not on the tasks that held the rows. When
    the job commits, Spark removes old month folders and moves new ones in, so a reader can meet the
    gap between the two; tables that are read meanwhile are better written in versions.
    """
    df = df.hint("rebalance", X.MONTH_COLUMN)
    order = [X.MONTH_COLUMN] + ([sort_by] if sort_by else [])
    (
        df.sortWithinPartitions(*order)
        .write.partitionBy(X.MONTH_COLUMN)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .option("parquet.compression.codec.zstd.level", LEVEL)
        .parquet(path)
    )


def read_months(
    spark: SparkSession, path: str, schema: T.StructType | None, months: list[str] | None = None
) -> DataFrame:
    """Stored months, the month key as text and in its place; only the named months are read.

    Without ``schema`` the table describes itself, by the columns of all its files, and the month
    key is turned into text. Of a table in versions the newest whole version is read.
    """
    from . import versions

    if versions.current_version(spark, path):
        rows = versions.read_version(spark, path, schema, months)
        return spark.createDataFrame([], f"{X.MONTH_COLUMN} string") if rows is None else rows
    if schema is not None:
        df = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    else:
        # Only the footers of the months that are read.
        only = "*" if months is None else "{" + ",".join(sorted(months)) + "}"
        reader = spark.read.option("mergeSchema", "true").option("basePath", path)
        df = reader.parquet(f"{path.rstrip('/')}/{X.MONTH_COLUMN}={only}")
        if not isinstance(df.schema[X.MONTH_COLUMN].dataType, T.StringType):
            df = df.withColumn(X.MONTH_COLUMN, F.col(X.MONTH_COLUMN).cast("string"))
    return df if months is None else df.filter(F.col(X.MONTH_COLUMN).isin(months))


def stored_files(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """Month and modification time of each file of a stored table, from the listing alone.

    With ``months`` only the folders of those months are listed.
    """
    only = "*" if months is None else "{" + ",".join(sorted(months)) + "}"
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(f"{path.rstrip('/')}/{X.MONTH_COLUMN}={only}")
        .select(
            F.regexp_extract("path", rf"{X.MONTH_COLUMN}=(\d{{6}})/", 1).alias(X.MONTH_COLUMN),
            "modificationTime",
        )
    )
