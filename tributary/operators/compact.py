"""Bringing the parts of a month together: union, keep the latest copy per key, statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fields as X

# Which copy of a document wins, most important first; all newest / highest first.
TIE_BREAKERS = ["source_file_mtime", "ingested_at", "source_file_path", "source_entry_path"]
SCOPE = ["source", X.MONTH_COLUMN]


def concat_parts(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, copies included, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def keep_latest(
    df: DataFrame,
    key: str | list[str],
    scope: list[str] = SCOPE,
    newest_first: list[str | Column] = TIE_BREAKERS,
) -> DataFrame:
    """One row per key inside each scope: the newest, NULLs counting as oldest.

    Rows without a key are dropped. Spark plans the rank filter as a group limit before and after
    the shuffle: each map task sends at most one row per key, so a key that holds a large part of
    the rows costs no more than any other.
    """
    keys = [key] if isinstance(key, str) else key
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in newest_first]
    window = Window.partitionBy(*scope, *keys).orderBy(*order)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.filter(present)
        .withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def keep_latest_narrow(
    df: DataFrame,
    key: str | list[str],
    scope: list[str] = SCOPE,
    newest_first: list[str] = TIE_BREAKERS,
) -> DataFrame:
    """Same result by partial aggregation, with the rows as part of the aggregate.

    The aggregate keeps one candidate per key on the map side. Its buffer is a struct, so Spark sorts
    for it as it does for a window; it serves where a window function cannot be used. NULL order
    values are ranked below all others by pairing each with a presence flag.
    """
    keys = [key] if isinstance(key, str) else key
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rank = F.struct(
        *[e for c in newest_first for e in (F.col(c).isNotNull().alias(f"has_{c}"), F.col(c))]
    )
    rest = [c for c in df.columns if c not in scope + keys]
    best = (
        df.filter(present)
        .groupBy(*scope, *keys)
        .agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    )
    return best.select(*[c if c in scope + keys else F.col("_row")[c].alias(c) for c in df.columns])


def keep_statistics(df: DataFrame, key: str, scope: list[str] = SCOPE) -> DataFrame:
    """Per scope: rows before and after, copies removed and rows without a key, kept apart."""
    per_key = df.groupBy(*scope, key).agg(F.count(F.lit(1)).alias("copies"))
    return (
        per_key.groupBy(*scope)
        .agg(
            F.sum("copies").alias("rows_before"),
            F.count(key).alias("rows_after"),
            F.sum(F.when(F.col(key).isNull(), F.col("copies")).otherwise(0)).alias("null_keys"),
        )
        .withColumn(
            "dupes_removed", F.col("rows_before") - F.col("rows_after") - F.col("null_keys")
        )
    )


def merge_months(stored: DataFrame, new: DataFrame, key: str, **options) -> DataFrame:
    """Stored and new rows of the same months, one row per key."""
    return keep_latest(concat_parts(stored, new), key, **options)
