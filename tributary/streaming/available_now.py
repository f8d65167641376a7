"""Ingestion driven by a stream of listed files that drains what is there and stops.

The stream reads a queue: tables of listed files, each small enough for one micro-batch. Listing itself is
done by tasks, as in a batch run, so every name counts, hidden ones too, and what is new is found by a
join with the queue. The stream's own checkpoint remembers tables of the queue, a few names for each call,
and no names of documents. Each micro-batch runs the same job as a batch run over the files of its table,
so the ledger, the rules and the results are the same. Only tables and flat copies wait: small batches all
merge into the same few buckets, and each would write these again. What a batch has read lies in a folder
next to the queue, which outlives a call that broke, until enough documents are there or the call ends.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..plans.flat_tables import flatten_tables
from ..plans.ingest import IngestOptions, ingest, output_tables, settle, staged_bytes
from ..plans.work import names_in, remove_folder, work_folder
from ..sources.files import list_files

FILES_PER_BATCH = 1_000_000
BYTES_PER_BATCH = 256 << 30
#: Bytes of documents that wait before they are merged into the tables; at the end of a call fewer are.
BYTES_PER_MERGE = 1 << 30
KEY = ["source", "source_file_path", "fingerprint"]


def queue_files(
    spark: SparkSession,
    files: DataFrame,
    queue: str,
    files_per_batch: int = FILES_PER_BATCH,
    bytes_per_batch: int = BYTES_PER_BATCH,
) -> int:
    """Adds files that the queue does not hold yet, dealt to as many tables as their number and bytes ask for."""
    if names_in(spark, queue):
        files = files.join(spark.read.schema(files.schema).parquet(queue), KEY, "left_anti").select(*files.columns)
    size = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    if size["n"]:
        batches = max(math.ceil(size["n"] / files_per_batch), math.ceil(size["bytes"] / bytes_per_batch))
        # Dealt round robin: tables of one queue call have nearly as many files.
        files.repartition(batches).write.mode("append").parquet(queue)
    return size["n"]


def queued_files(spark: SparkSession, queue: str, schema: T.StructType) -> DataFrame:
    """The queue as a stream, a table at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(queue)


def ingest_stream(
    spark: SparkSession,
    options: IngestOptions,
    checkpoint_path: str,
    files_per_batch: int = FILES_PER_BATCH,
    bytes_per_batch: int = BYTES_PER_BATCH,
) -> None:
    """Processes all files not delivered before and returns.

    A call that broke leaves its tables in the queue, and the next one goes on with them. A micro-batch that
    is repeated after a failure is a run of its own: files that the first attempt got into the ledger are
    skipped, the others are read again and absorbed by keep-latest. Documents are merged into the tables when
    ``BYTES_PER_MERGE`` of them wait and at the end, and the flat copies are brought up to date once, also
    when a micro-batch fails; what a call could not merge or flatten, the next one does. With mode "replace"
    each micro-batch writes the tables itself.
    """
    staged = "" if options.mode == "replace" else f"{checkpoint_path.rstrip('/')}/staged"
    options = replace(options, staged_path=staged)
    if staged and settle(spark, options):  # what waits since a call that broke
        raise RuntimeError("documents that wait could not be merged; the next call tries again")
    queue = f"{checkpoint_path.rstrip('/')}/queue"
    work = f"{work_folder(spark, options.state_path)}/listing-{uuid.uuid4().hex}"
    listed = [list_files(spark, s.root, s.name, f"{work}/{s.name}") for s in options.sources]
    files = reduce(DataFrame.unionByName, listed)
    queue_files(spark, files, queue, files_per_batch, bytes_per_batch)
    remove_folder(spark, work)
    if not names_in(spark, queue):
        return

    waiting = 0

    def run(batch: DataFrame, batch_id: int) -> None:
        nonlocal waiting
        run_id = f"stream-{batch_id:08d}-{uuid.uuid4().hex[:8]}"
        result = ingest(batch.sparkSession, replace(options, run_id=run_id, flatten=False), files=batch)
        if result.had_errors:
            raise RuntimeError(f"micro-batch {batch_id} had errors; it will be repeated")
        waiting += staged_bytes(spark, options, run_id) if staged else 0
        if waiting >= BYTES_PER_MERGE:
            waiting = 0
            if settle(spark, options):
                raise RuntimeError(f"documents up to micro-batch {batch_id} could not be merged; they wait")

    query = (
        queued_files(spark, queue, files.schema).writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{checkpoint_path.rstrip('/')}/stream")
        .trigger(availableNow=True)
        .start()
    )
    unmerged = False
    try:
        query.awaitTermination()
    finally:
        unmerged = bool(staged) and settle(spark, options)
        flat_failed = options.flatten and flatten_tables(spark, output_tables(options.sources), options.window)
    if unmerged:
        raise RuntimeError("documents could not be merged into the tables; the next call tries again")
    if flat_failed:
        raise RuntimeError("flat copies could not be brought up to date; the next call tries again")
