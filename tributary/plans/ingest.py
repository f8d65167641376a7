"""Incremental ingestion: files to monthly tables, ledger, quarantine, metrics and flat tables.

One run makes these jobs:

1. list files, drop the known ones       -> ``listed``, ``folders`` and ``pending`` work tables
   name the documents inside them         -> ``entries`` work table
2. read and parse each document exactly once                        -> ``documents`` work table
3. per output table: rank narrow rows, write the buckets that get rows, then the manifest
4. quarantine from narrow columns of ``documents``; run counters were observed while it was written
5. ledger, only for sources without errors, after their tables were written; folders without news
6. flat copies of the months that changed

With ``staged_path`` a run ends after step 2 and its counters: what it read waits there, and :func:`settle`
does steps 3 to 5 for all runs that wait.

The work tables cut the lineage: later jobs read columns from Parquet instead of parsing again, and
a lost executor repeats a task, not the run. Output tables have versions: a run that breaks leaves the
version before it as it was, and the files it did not get into the ledger are read again. A file that
cannot be read is an error of its source: it gets no ledger row, and the others go on.
"""

from __future__ import annotations

import logging
import math
import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from .. import fields as X
from ..operators import metrics, rules, state
from ..schemas import CTE_SCHEMA, NFE_SCHEMA
from ..sinks.versions import merge_version, positions
from ..sources.archives import NO_DOCUMENTS, UNREADABLE, list_entries, loose_entries, read_entries
from ..sources.files import list_files, unlisted_folders
from .documents import both_rows, parse_documents
from .flat_tables import flatten_tables
from .work import bytes_in, names_in, remove_folder, work_folder

log = logging.getLogger(__name__)

BYTES_PER_TASK = 64 << 20
DOCUMENTS_PER_TASK = 50_000
ARCHIVES_PER_TASK = 16


@dataclass(frozen=True)
class Source:
    """One input folder. ``freight_table`` is set where waybills are wanted as well."""

    name: str
    root: str
    invoice_table: str
    freight_table: str | None = None
    freight_name: str | None = None

    @property
    def freight_source(self) -> str:
        return self.freight_name or f"{self.name}_cte"


def targets_of(source: Source) -> list[tuple[str, str, str]]:
    """Kind, table and source name of what a source gives."""
    invoices = [("nfe", source.invoice_table, source.name)]
    return invoices + ([("cte", source.freight_table, source.freight_source)] if source.freight_table else [])


def output_tables(sources: tuple[Source, ...]) -> list[tuple[str, str]]:
    """Path and kind of the tables of all sources."""
    return [(path, kind) for source in sources for kind, path, _ in targets_of(source)]


@dataclass(frozen=True)
class IngestOptions:
    sources: tuple[Source, ...]
    state_path: str
    now: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    min_year: int = X.DEFAULT_MIN_YEAR
    window_months: int = X.DEFAULT_WINDOW_MONTHS
    # "merge" keeps the stored documents of a month, "replace" keeps only those of this run.
    mode: str = "merge"
    # True: a damaged archive or member makes the run fail for its source, as opposed to
    # putting that member into quarantine and keeping the rest.
    strict_archives: bool = False
    flatten: bool = True
    run_id: str = ""
    # A folder in which the documents of a run wait for ``settle``; without it a run writes the tables itself.
    staged_path: str = ""

    def __post_init__(self):
        if self.mode not in ("merge", "replace"):
            raise ValueError(f"mode must be merge or replace, not {self.mode!r}")
        if self.staged_path and self.mode != "merge":
            raise ValueError("only documents that are merged can wait for other runs")

    @property
    def ledger_path(self) -> str:
        return f"{self.state_path.rstrip('/')}/ledger"

    @property
    def quarantine_path(self) -> str:
        return f"{self.state_path.rstrip('/')}/quarantine"

    @property
    def metrics_path(self) -> str:
        return f"{self.state_path.rstrip('/')}/runs"

    @property
    def window(self) -> list[str]:
        return rules.month_window(_utc(self.now), self.window_months)


@dataclass(frozen=True)
class RunResult:
    run_id: str
    had_errors: bool
    months: list[str]
    counts: DataFrame
    missing_sources: tuple[str, ...] = ()


def _utc(now: datetime) -> datetime:
    return now.astimezone(timezone.utc).replace(tzinfo=None) if now.tzinfo else now


def _stamp(now: datetime) -> Column:
    """Zone-less UTC time as a column; as text, so that no time zone setting touches it."""
    return F.lit(_utc(now).isoformat(sep=" ", timespec="milliseconds")).cast("timestamp_ntz")


def _run_id(options: IngestOptions) -> str:
    return options.run_id or f"{_utc(options.now):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def _listing(spark: SparkSession, options: IngestOptions, work: str) -> tuple[DataFrame | None, DataFrame | None, list[str]]:
    """Files of all sources, folders that could not be listed, and sources that are not there."""
    found, closed, missing = None, None, []
    for source in options.sources:
        folder = f"{work}/listing/{source.name}"
        try:
            files = list_files(spark, source.root, source.name, folder)
        except OSError as error:
            log.error("%s", error)
            missing.append(source.name)
            continue
        errors = unlisted_folders(spark, source.name, folder)
        found = files if found is None else found.unionByName(files)
        closed = errors if closed is None else closed.unionByName(errors)
    return found, closed, missing


def documents_of(spark: SparkSession, files: DataFrame, work: str) -> DataFrame:
    """Documents of listed files with their bytes; the listing is fixed in a work table first."""
    entries_path = f"{work}/entries"
    archives = files.filter(F.col("source_file_type") == "zip").count()
    listed = list_entries(files, max(1, math.ceil(archives / ARCHIVES_PER_TASK)), f"{work}/directories") if archives else loose_entries(files)
    listed.write.mode("overwrite").parquet(entries_path)
    entries = spark.read.parquet(entries_path).filter(
        F.col("method").isNull() | (F.col("method") != NO_DOCUMENTS)
    )
    size = entries.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("document_bytes"), F.lit(0)).alias("bytes")
    ).first()
    tasks = max(
        1,
        math.ceil(size["bytes"] / BYTES_PER_TASK),
        math.ceil(size["n"] / DOCUMENTS_PER_TASK),
        min(spark.sparkContext.defaultParallelism, size["n"]),
    )
    return read_entries(entries, tasks)


def typed_documents(documents: DataFrame, options: IngestOptions) -> DataFrame:
    """Parsed documents with ``status``, kept to what the later jobs need."""
    parsed = parse_documents(
        documents.withColumn("ingested_at", _stamp(options.now))
    )
    freight = {s.name: s.freight_source for s in options.sources if s.freight_table}
    wanted_freight = F.col("source").isin(list(freight)) if freight else F.lit(False)
    allowed = rules.within_rules(options.min_year, options.window)
    status = (
        F.when(F.col("error_type").startswith(UNREADABLE), F.lit("unreadable"))
        .when(F.col("outcome") == "corrupt", F.lit("corrupt"))
        .when(F.col("outcome") == "empty", F.lit("empty"))
        .when(F.col("outcome") == "no_body", F.lit("no_body"))
        # A waybill where only invoices are wanted has no invoice body.
        .when((F.col("kind") == "cte") & ~wanted_freight, F.lit("no_body"))
        .when(allowed, F.lit("ok"))
        .otherwise(F.lit("filtered"))
    )
    return parsed.withColumn("status", status)


NARROW = [
    "source", "source_root", "source_file_path", "source_file_type", "source_entry_path",
    "fingerprint", "kind", "status", "error_type", "error_message", X.MONTH_COLUMN,
]
#: Folder column of the documents of runs that wait.
RUN = "_run"
DOCUMENTS_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in NARROW] + [T.StructField("nfe", NFE_SCHEMA), T.StructField("cte", CTE_SCHEMA)]
)


def _table_of(documents: DataFrame, kind: str, source: str, name: str) -> DataFrame:
    """Rows for one output table, with their places in the work table."""
    rows = documents.filter(
        (F.col("status") == "ok") & (F.col("kind") == kind) & (F.col("source") == source)
    ).select(f"{kind}.*", *positions())
    return rows.withColumn("source", F.lit(name))


def _file_rows(documents: DataFrame) -> DataFrame:
    """One row per file that counts as processed, with the months found in it.

    A file counts when it gave a document, wanted or not. A loose file that is empty or corrupt
    does not, so that it is looked at again (or skipped by quarantine); an archive counts unless
    it could not be opened at all. A file that could not be read whole does not. Months are a short list: at most one entry per month.
    """
    accepted = F.col("status").isin("ok", "filtered", "no_body")
    opened = F.col("source_entry_path").isNotNull()
    return (
        documents.groupBy("source", "source_file_path", "fingerprint")
        .agg(
            (F.bool_or(accepted | opened) & ~F.bool_or(F.col("status") == "unreadable")).alias("accepted"),
            F.array_join(
                F.sort_array(F.collect_set(F.when(F.col("status") == "ok", F.col(X.MONTH_COLUMN)))),
                state.MONTH_SEPARATOR,
            ).alias("months"),
        )
        .filter("accepted")
    )


def _without_documents(entries: DataFrame) -> DataFrame:
    """Archives that were opened and hold no document: processed, so that no run opens them again."""
    return (
        entries.filter(F.col("method") == NO_DOCUMENTS)
        .select("source", "source_file_path", "fingerprint")
        .distinct()
        .select("*", F.lit(True).alias("accepted"), F.lit("").alias("months"))
    )


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _counts(
    spark: SparkSession, options: IngestOptions, observed: dict[str, int], scanned: DataFrame, pending: DataFrame, closed: DataFrame | None
) -> list[dict]:
    """Counters per source that was scanned: files, documents per outcome, errors, months written.

    A folder that could not be listed is an error of its source. Each of the inputs has a row per source.
    """
    files = {r["source"]: r.asDict() for r in scanned.collect()}
    waiting = {r["source"]: r["count"] for r in pending.groupBy("source").count().collect()}
    shut = {r["source"]: r["count"] for r in closed.groupBy("source").count().collect()} if closed is not None else {}
    names = [s.name for s in options.sources]
    months = metrics.observed_months(observed, names)
    rows = []
    for at, name in enumerate(names):
        if name not in files and name not in shut:
            continue
        row = {"source": name, "total": 0, "xml": 0, "zip": 0} | files.get(name, {})
        row |= {status: observed.get(f"{at}|{status}", 0) for status in metrics.STATUSES}
        broken = observed.get(f"{at}|broken", 0) if options.strict_archives else 0
        row["months"] = sorted({month for kind in KINDS for month in months.get((name, kind), {})})
        row |= {"errors": observed.get(f"{at}|unreadable", 0) + broken + shut.get(name, 0), "broken": broken}
        # Known by the ledger or held in quarantine.
        row["skipped"] = row["total"] - waiting.get(name, 0)
        rows.append(row)
    return rows


COUNTS_DDL = (
    "source string, total bigint, xml bigint, zip bigint, ok bigint, filtered bigint, empty bigint, no_body bigint, corrupt bigint, "
    "months array<string>, errors bigint, skipped bigint"
)
KINDS = ("nfe", "cte")


def _pending(
    spark: SparkSession, options: IngestOptions, listing: DataFrame, folders: DataFrame | None, quarantine: DataFrame, work: str
) -> DataFrame:
    """Files to read. Where the listing is whole, only folders that it shows to have changed are looked up."""
    parts = None
    if folders is not None:
        known = state.known_folders(spark, options.ledger_path)
        changed = _kept(folders.join(known, folders.columns, "left_anti"), f"{work}/changed")
        # At most one value per part of the ledger.
        parts = [r[0] for r in changed.select(state.ledger_part(F.col("folder"))).distinct().collect()]
        listing = state.in_changed_folders(listing, changed)
    ledger = state.read_ledger(spark, options.ledger_path, parts)
    return state.not_quarantined(state.not_processed(listing, ledger), quarantine)


def _note_settled(spark: SparkSession, options: IngestOptions, folders: DataFrame, pending: DataFrame, done: DataFrame) -> None:
    """Notes the folders of which no file is left that another run would read."""
    left = pending.join(done, ["source", "source_file_path", "fingerprint"], "left_anti")
    unsettled = left.select("source", state.folder_of().alias("folder")).distinct()
    state.note_folders(spark, options.ledger_path, folders.join(unsettled, ["source", "folder"], "left_anti").select(*folders.columns))


def ingest(spark: SparkSession, options: IngestOptions, files: DataFrame | None = None) -> RunResult:
    """One run over all sources. ``files`` replaces the listing, as the stream does."""
    run_id = _run_id(options)
    options = replace(options, run_id=run_id)
    work = f"{work_folder(spark, options.state_path)}/{run_id}"

    listing, closed, missing = (files, None, []) if files is not None else _listing(spark, options, work)
    if listing is None:
        return RunResult(run_id, True, [], spark.createDataFrame([], "source string"), tuple(missing))

    quarantine = state.read_quarantine(spark, options.quarantine_path)
    listing = _kept(listing, f"{work}/listed")
    folders = None if files is not None else _kept(state.folder_listing(listing), f"{work}/folders")
    pending = _kept(_pending(spark, options, listing, folders, quarantine, work), f"{work}/pending")

    typed = typed_documents(documents_of(spark, pending, work), options)
    staged = options.staged_path.rstrip("/")
    documents_path = f"{staged}/documents/{RUN}={run_id}" if staged else f"{work}/documents"
    names = [source.name for source in options.sources]
    counters = Observation("documents")
    rows = both_rows(typed, "status = 'ok'", NARROW)
    rows = rows.observe(counters, *metrics.observed_counters(names, list(KINDS), options.window))
    # Each output table reads the folder of its source and kind, and no other.
    rows.write.partitionBy("source", "kind").mode("overwrite").parquet(documents_path)
    documents = spark.read.schema(rows.schema).parquet(documents_path)
    observed = counters.get
    present = metrics.observed_months(observed, names)
    counts = _counts(spark, options, observed, metrics.scan_counts(listing), pending, closed)
    erring = [row["source"] for row in counts if row["errors"]]
    failed = {row["source"] for row in counts if row["broken"]}

    flat_failed = False
    if staged:
        if any(row["zip"] for row in counts):
            _without_documents(spark.read.parquet(f"{work}/entries")).write.parquet(f"{staged}/without/{RUN}={run_id}")
    else:
        without = _without_documents(spark.read.parquet(f"{work}/entries"))
        done = _file_rows(documents).unionByName(without)
        failed, done = _store(spark, options, documents, done, present, failed, work, run_id)
        if folders is not None:
            _note_settled(spark, options, folders, pending, done)
        state.compact_ledger(spark, options.ledger_path, f"{work}/ledger")
        flat_failed = flatten_tables(spark, output_tables(options.sources), options.window) if options.flatten else False

    had_errors = bool(failed or erring or missing or flat_failed)
    summary = spark.createDataFrame([{k: v for k, v in row.items() if k != "broken"} for row in counts], COUNTS_DDL).coalesce(1).withColumns(
        {
            "run_id": F.lit(run_id),
            "ran_at": _stamp(options.now),
            "had_errors": F.lit(had_errors),
        }
    )
    # Written last: of a staged run it says that all of its documents wait.
    state.append_state(summary, options.metrics_path, run_id)
    if not failed or staged:
        remove_folder(spark, work)
    return RunResult(
        run_id,
        had_errors,
        sorted({month for months in present.values() for month in months}),
        spark.read.parquet(f"{options.metrics_path}/run_id={run_id}"),
        tuple(missing),
    )


def _store(
    spark: SparkSession, options: IngestOptions, documents: DataFrame, done: DataFrame,
    present: dict[tuple[str, str], dict[str, int]], failed: set[str], work: str, label: str,
) -> tuple[set[str], DataFrame]:
    """Tables, quarantine and ledger of documents that were read; sources that failed, files that are done.

    Tables first, ledger last: a crash in between reads the files again, which merging absorbs.
    """
    failed, at_table = set(failed), 0
    for source in options.sources:
        for kind, path, name in targets_of(source):
            at_table += 1
            new_rows = present.get((source.name, kind))
            if not new_rows:
                continue
            try:
                key, schema = (X.NFE_KEY, NFE_SCHEMA) if kind == "nfe" else (X.CTE_KEY, CTE_SCHEMA)
                merge_version(
                    spark, path, _table_of(documents, kind, source.name, name), key=key, schema=schema,
                    work=f"{work}/losers/{at_table:03d}", mode=options.mode, new_rows=new_rows,
                )
            except Exception as error:
                failed.add(source.name)
                log.error("writing %s failed: %s", path, error)

    at = _stamp(options.now)
    failures = documents.filter(F.col("status") == "corrupt")
    state.append_state(state.quarantine_rows(failures, at), options.quarantine_path, label)
    done = done.filter(~F.col("source").isin(list(failed))) if failed else done
    state.append_state(
        state.ledger_rows(done, at, F.nullif("months", F.lit(""))), options.ledger_path, label
    )
    return failed, done


def staged_runs(spark: SparkSession, options: IngestOptions) -> list[str]:
    """Runs whose documents wait, of those that came to their end."""
    names = names_in(spark, f"{options.staged_path.rstrip('/')}/documents")
    runs = sorted(name.removeprefix(f"{RUN}=") for name in names if name.startswith(f"{RUN}="))
    return [run for run in runs if "_SUCCESS" in names_in(spark, f"{options.metrics_path}/run_id={run}")]


def staged_bytes(spark: SparkSession, options: IngestOptions, run_id: str) -> int:
    """Size of what a run has left to wait."""
    return bytes_in(spark, f"{options.staged_path.rstrip('/')}/documents/{RUN}={run_id}")


def settle(spark: SparkSession, options: IngestOptions) -> bool:
    """Brings the documents that wait in ``staged_path`` into tables, quarantine and ledger; True if a table failed.

    All runs that wait are merged as one. A run that did not come to its end counts as none: its files are
    read again. What a table failed for goes on waiting, for the next call.
    """
    staged = options.staged_path.rstrip("/")
    runs = staged_runs(spark, options)
    if not runs:
        remove_folder(spark, staged)
        return False
    work = f"{work_folder(spark, options.state_path)}/settle-{uuid.uuid4().hex}"
    run = T.StructField(RUN, T.StringType())
    read = spark.read.schema(T.StructType([*DOCUMENTS_SCHEMA.fields, run])).parquet(f"{staged}/documents")
    documents = read.where(F.col(RUN).isin(runs))
    ok = documents.where("status = 'ok'").groupBy("source", "kind", X.MONTH_COLUMN).count().collect()
    present: dict[tuple[str, str], dict[str, int]] = {}
    for source, kind, month, count in ok:
        present.setdefault((source, kind), {})[month] = count
    counted = documents
    if options.strict_archives:
        # A damaged member fails its source for the run that read it.
        broken = documents.where("status = 'corrupt' and source_file_type = 'zip'").select(RUN, "source").distinct()
        counted = documents.join(F.broadcast(broken), [RUN, "source"], "left_anti")
    done = _file_rows(counted)
    if names_in(spark, f"{staged}/without"):
        without = spark.read.schema(T.StructType([*done.schema.fields, run])).parquet(f"{staged}/without").where(F.col(RUN).isin(runs))
        if options.strict_archives:
            without = without.join(F.broadcast(broken), [RUN, "source"], "left_anti")
        done = done.unionByName(without.select(*done.columns))
    # A name made of the runs: settling them again after a crash replaces the rows.
    failed, _ = _store(spark, options, documents, done, present, set(), work, f"{runs[0]}-to-{runs[-1]}")
    state.compact_ledger(spark, options.ledger_path, f"{work}/ledger")
    remove_folder(spark, work)
    if not failed:
        remove_folder(spark, staged)
    return bool(failed)


def forget(spark: SparkSession, options: IngestOptions, months: list[str]) -> None:
    """Lets the next run read all files again that gave documents of these months."""
    ledger = state.read_ledger(spark, options.ledger_path)
    rows = state.forget_months(ledger, months, _stamp(options.now))
    state.append_state(rows, options.ledger_path, f"forget-{uuid.uuid4().hex[:8]}")
    state.forget_folders(spark, options.ledger_path)
