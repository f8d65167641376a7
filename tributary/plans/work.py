"""Where a run keeps the tables that cut its lineage."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def work_folder(spark: SparkSession, otherwise: str) -> str:
    """Shared folder named by the cluster, else a folder next to the state of the job.

    Written tables survive the loss of executors, unlike blocks kept on them.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )
    return (named or f"{otherwise.rstrip('/')}/work").rstrip("/")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a finished run's work tables, in whatever store they are."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder, none if it is not there. For folders that are known to hold few."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []


def bytes_in(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, 0 if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getContentSummary(target).getLength() if system.exists(target) else 0


def newest_whole(spark: SparkSession, path: str) -> int:
    """Largest number of a table in a folder of numbered ones, of those written to the end; 0 if none is."""
    for number in sorted((int(name) for name in names_in(spark, path) if name.isdigit()), reverse=True):
        if "_SUCCESS" in names_in(spark, f"{path}/{number:012d}"):
            return number
    return 0


def spread(df: DataFrame, rows_per_task: int) -> DataFrame:
    """Rows dealt out evenly, for work that costs far more per row than reading the row did.

    The number of tasks is given to Spark outright: left alone it would go by bytes, and put all
    rows of a small file into one task. Counting the rows of a Parquet table reads footers only.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(df.count() / rows_per_task))
    return df.repartition(tasks)
