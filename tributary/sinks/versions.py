"""Tables in versions: parts (months), buckets of keys, and manifests that name the files of a version.

A table has data in ``_data/_version=<v>/<column>=<part>/_bucket=<b>`` and manifests in ``_manifest/<n>``. The
column is the month, unless a function is told another one. A part is split into buckets by a hash of the
row's key, as many as its rows need. A manifest has one row per part and bucket and names the version that holds its rows, so a version shares all buckets that
it did not change with the one before. Writing adds data first and the manifest last: the manifest is one
small file, and it counts once its ``_SUCCESS`` mark is there, which Spark writes as the last step. A
reader takes the newest manifest that counts and sees one whole version, whatever is written meanwhile.
The files of replaced buckets are removed when ``KEPT`` newer versions exist.

Merging ranks narrow rows only (key, tie-breakers, position in a file). What loses, in general few rows,
is a list of positions; wide rows are read once more without these and go through one exchange, by month
and bucket. Only the buckets that get new rows are read and written.

One run at a time may write a table; a second one fails at the manifest, which it finds written, and leaves
nothing but data that no manifest names. Plain folders (``ref_aaaamm=<month>``), as ``write_months`` leaves
them, become part of the first version as they are.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from .. import fields as X
from ..operators.compact import SCOPE, TIE_BREAKERS, keep_latest
from ..plans.work import names_in, newest_whole, remove_folder
from .monthly import CODEC, LEVEL

MANIFEST_DDL = "part string, bucket int, buckets int, version string, rows bigint, built_from string"
#: Rows per bucket that a part is split for; a part is split anew when its buckets hold twice as many.
ROWS_PER_BUCKET = 500_000
#: Positions of losing rows that are broadcast; more of them are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Versions that stay readable.
KEPT = 2

FILE, ROW = "_file", "_row"
#: Folder columns, and the bucket of a row while it is written; names that no document column has.
VERSION, BUCKET = "_version", "_bucket"
PLAIN = ""


def positions() -> list[Column]:
    """File and row number of each row, for a DataFrame that reads Parquet files."""
    return [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)]


def located(rows: DataFrame, folder: str) -> DataFrame:
    """The rows as a work table in ``folder``, with the places that merging asks for."""
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder).select("*", *positions())


# --------------------------------------------------------------------------- manifests


def _manifest_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/_manifest/{number:012d}"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in names_in(spark, f"{path.rstrip('/')}/_manifest") if name.isdigit())


def current_version(spark: SparkSession, path: str) -> int:
    """Number of the newest version that counts; 0 if the table has none."""
    return newest_whole(spark, f"{path.rstrip('/')}/_manifest")


def manifest(spark: SparkSession, path: str, number: int | None = None, column: str = X.MONTH_COLUMN) -> DataFrame:
    """Rows of a manifest, of the newest one by default; those of the plain folders if there is none."""
    number = current_version(spark, path) if number is None else number
    if number:
        return spark.read.schema(MANIFEST_DDL).parquet(_manifest_path(path, number))
    prefix = f"{column}="
    parts = [name.removeprefix(prefix) for name in names_in(spark, path) if name.startswith(prefix)]
    return spark.createDataFrame([(m, 0, 1, PLAIN, None, None) for m in parts], MANIFEST_DDL)


def commit(spark: SparkSession, path: str, base: int, entries: DataFrame) -> int:
    """Makes ``entries`` the version after ``base``; fails if another run did so first."""
    entries.coalesce(1).write.mode("error").parquet(_manifest_path(path, base + 1))
    return base + 1


def new_label(base: int) -> str:
    """Name of the data of a run; never that of a run that broke."""
    return f"{base + 1:012d}-{uuid.uuid4().hex[:8]}"


def expire(spark: SparkSession, path: str, keep: int = KEPT, column: str = X.MONTH_COLUMN) -> None:
    """Removes manifests beyond the newest ``keep``, what only they name, and data of broken runs."""
    newest = current_version(spark, path)
    numbers = [n for n in _numbers(spark, path) if n <= newest]
    old, kept = numbers[:-keep], numbers[-keep:]
    if not kept:
        return
    named = reduce(DataFrame.unionByName, [manifest(spark, path, n, column) for n in kept])
    place = ["part", "bucket", "version"]
    for number in old:
        dropped = manifest(spark, path, number, column).join(named, place, "left_anti").select(*place).distinct()
        for entry in dropped.collect():  # the buckets that one run replaced
            remove_folder(spark, _place(path, entry, column))
        remove_folder(spark, _manifest_path(path, number))
    used = {r[0] for r in named.select("version").distinct().collect()}
    for name in names_in(spark, f"{path.rstrip('/')}/_data"):
        label = name.removeprefix(f"{VERSION}=")
        if label not in used and int(label.split("-")[0]) <= newest:
            remove_folder(spark, f"{path.rstrip('/')}/_data/{name}")


# --------------------------------------------------------------------------- reading


def data_folder(path: str, label: str) -> str:
    return f"{path.rstrip('/')}/_data/{VERSION}={label}"


def _place(path: str, entry: Row, column: str) -> str:
    if entry["version"] == PLAIN:
        return f"{path.rstrip('/')}/{column}={entry['part']}"
    return f"{data_folder(path, entry['version'])}/{column}={entry['part']}/{BUCKET}={entry['bucket']}"


def entries_of(
    spark: SparkSession, path: str, parts: Iterable[str] | None = None, number: int | None = None, column: str = X.MONTH_COLUMN
) -> list[Row]:
    """Manifest rows of some parts, one per bucket: what a reader or writer of them has to know."""
    rows = manifest(spark, path, number, column)
    return (rows if parts is None else rows.where(F.col("part").isin(list(parts)))).collect()


def read_entries(
    spark: SparkSession, path: str, entries: list[Row], schema: T.StructType | None, more: tuple[str, ...] = (), column: str = X.MONTH_COLUMN
) -> DataFrame | None:
    """Rows of the named buckets, with ``more`` of: file position columns, bucket column.

    Without ``schema`` the columns are those of all files read. None if there is nothing to read and no
    schema that would describe it.
    """
    found = []
    for plain in (True, False):
        some = [e for e in entries if (e["version"] == PLAIN) == plain]
        if not some:
            continue
        base = path.rstrip("/") if plain else f"{path.rstrip('/')}/_data"
        reader = spark.read.option("basePath", base)
        reader = reader.option("mergeSchema", "true") if schema is None else reader.schema(schema)
        rows = reader.parquet(*[_place(path, e, column) for e in some])
        names = [c for c in rows.columns if c not in (VERSION, BUCKET)] if schema is None else schema.fieldNames()
        columns = [F.col(c).cast("string").alias(c) if c == column else F.col(c) for c in names]
        extra = {FILE: positions()[0], ROW: positions()[1], BUCKET: (F.lit(0) if plain else F.col(BUCKET).cast("int")).alias(BUCKET)}
        found.append(rows.select(*columns, *[extra[name] for name in more]))
    if found:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    if schema is None:
        return None
    kinds = {FILE: "string", ROW: "bigint", BUCKET: "int"}
    return spark.createDataFrame([], schema).select("*", *[F.lit(None).cast(kinds[name]).alias(name) for name in more])


def read_version(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    parts: list[str] | None = None,
    number: int | None = None,
    column: str = X.MONTH_COLUMN,
) -> DataFrame | None:
    """One whole version, the newest by default. Later writes do not change what the result holds."""
    return read_entries(spark, path, entries_of(spark, path, parts, number, column), schema, (), column)


# --------------------------------------------------------------------------- writing


def bucket_of(key: str, buckets: dict[str, int], column: str = X.MONTH_COLUMN) -> Column:
    """Bucket of a row's key in its part."""
    counts = F.create_map(*[F.lit(x) for pair in buckets.items() for x in pair])
    return F.pmod(F.xxhash64(key), F.element_at(counts, F.col(column))).cast("int")


def bucket_counts(entries: list[Row], new_rows: dict[str, int]) -> dict[str, int]:
    """Buckets for each part that gets rows: as stored, or the next power of two where they are too full."""
    by_part: dict[str, list[Row]] = {}
    for entry in entries:
        by_part.setdefault(entry["part"], []).append(entry)
    counts = {}
    for part, new in new_rows.items():
        stored = by_part.get(part, [])
        total = new + sum(e["rows"] or 0 for e in stored)
        has = stored[0]["buckets"] if stored and stored[0]["version"] != PLAIN else 0
        wanted = 1 << max(0, math.ceil(math.log2(max(1, total) / ROWS_PER_BUCKET)))
        counts[part] = has if has and total <= 2 * ROWS_PER_BUCKET * has else max(has, wanted)
    return counts


def write_buckets(rows: DataFrame, path: str, label: str, sort_by: str | None, column: str = X.MONTH_COLUMN) -> str:
    """Writes rows with a part and a bucket as data of a version that no manifest names yet.

    The only exchange is the one that gathers buckets; Spark splits large ones and joins small ones.
    """
    folder = data_folder(path, label)
    order = [column, BUCKET] + ([sort_by] if sort_by else [])
    (
        rows.hint("rebalance", column, BUCKET)
        .sortWithinPartitions(*order)
        .write.partitionBy(column, BUCKET)
        .mode("overwrite")
        .option("compression", CODEC)
        .option("parquet.compression.codec.zstd.level", LEVEL)
        .parquet(folder)
    )
    return folder


def written_entries(
    spark: SparkSession, folder: str, label: str, buckets: dict[str, int], column: str = X.MONTH_COLUMN
) -> DataFrame:
    """Manifest rows of data that was just written; counting reads file footers only."""
    part = F.col(column).cast("string").alias("part")
    counted = spark.read.parquet(folder).groupBy(part, F.col(BUCKET).cast("int").alias("bucket")).count()
    counts = F.create_map(*[F.lit(x) for pair in buckets.items() for x in pair])
    return counted.select(
        "part", "bucket", F.element_at(counts, F.col("part")).alias("buckets"), F.lit(label).alias("version"),
        F.col("count").alias("rows"), F.lit(None).cast("string").alias("built_from"),
    )


def losing_positions(narrow: DataFrame, key: str, scope: list[str], newest_first: list[str]) -> DataFrame:
    """Positions of rows without a key, and of rows that are not the newest of their key.

    Both steps send narrow rows. The ranking sends one row per key and map task, and positions are all
    different, so a key that holds a large part of the rows gathers nowhere.
    """
    newest = keep_latest(narrow, key, scope, [*newest_first, FILE, ROW]).select(FILE, ROW)
    return narrow.select(FILE, ROW).join(_shuffled(newest), [FILE, ROW], "left_anti")


def _shuffled(places: DataFrame) -> DataFrame:
    """Positions to be joined by a shuffle. Their files are small for their number, as names and row numbers
    compress well, so Spark, which goes by bytes, would broadcast millions of them through the driver."""
    return places.hint("merge")


def merge_version(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    *,
    key: str,
    schema: T.StructType,
    work: str,
    mode: str = "merge",
    scope: list[str] = SCOPE,
    newest_first: list[str] = TIE_BREAKERS,
    new_rows: dict[str, int] | None = None,
    column: str = X.MONTH_COLUMN,
) -> int:
    """Adds rows to a table, one per key staying, and makes the result its next version.

    ``new`` has the columns of ``schema`` and the two of :func:`positions`. Where ``mode`` is "replace",
    a part that gets rows keeps only these. ``new_rows`` says how many rows each part gets, where
    that is known. Parts that get no rows with a key stay as they are. ``work`` is a folder for the
    positions of losing rows. Returns the number of the version.
    """
    base = current_version(spark, path)
    if new_rows is None:
        new_rows = {r[0]: r[1] for r in new.groupBy(column).count().collect() if r[0] is not None}
    if not new_rows:
        return base
    stored = entries_of(spark, path, list(new_rows), base, column) if mode == "merge" else []
    buckets = bucket_counts(stored, new_rows)
    new = new.where(F.col(column).isNotNull()).withColumn(BUCKET, bucket_of(key, buckets, column))
    touched = {tuple(r) for r in new.where(F.col(key).isNotNull()).select(column, BUCKET).distinct().collect()}
    if not touched:
        return base

    def split_anew(entry: Row) -> bool:
        return buckets[entry["part"]] != entry["buckets"] or entry["version"] == PLAIN

    parts = {part for part, _ in touched}
    stored = [e for e in stored if e["part"] in parts]
    met = [e for e in stored if (e["part"], e["bucket"]) in touched or split_anew(e)]
    columns = [*schema.fieldNames(), FILE, ROW]
    both = new.select(*columns, BUCKET)
    if met:
        old = read_entries(spark, path, met, schema, (FILE, ROW), column).withColumn(BUCKET, bucket_of(key, buckets, column))
        both = both.unionByName(old.select(*columns, BUCKET))

    narrow = both.select(*dict.fromkeys([*scope, key, *newest_first, FILE, ROW]))
    losing_positions(narrow, key, scope, newest_first).write.mode("overwrite").parquet(work)
    losers = spark.read.schema(f"{FILE} string, {ROW} bigint").parquet(work)
    count = losers.count()
    if count:
        both = both.join(F.broadcast(losers) if count <= BROADCAST_ROWS else _shuffled(losers), [FILE, ROW], "left_anti")
    label = new_label(base)
    folder = write_buckets(both.select(*schema.fieldNames(), BUCKET), path, label, key, column)

    written = written_entries(spark, folder, label, buckets, column)
    gone = sorted(parts if mode == "replace" else {e["part"] for e in met if split_anew(e)})
    before = manifest(spark, path, base, column)
    before = before.where(~F.col("part").isin(gone)) if gone else before
    commit(spark, path, base, before.join(written, ["part", "bucket"], "left_anti").unionByName(written))
    expire(spark, path, column=column)
    return base + 1
