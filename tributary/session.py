"""Session settings that the jobs like; none of them is needed for right results."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Document files are small: the default of 4 MB per file would put about 30 files in a task.
    "spark.sql.files.openCostInBytes": str(256 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "tributary", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
