"""Ledger, quarantine and run counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import metrics, state
from . import query, table
from .monthly import scratch

RUN_1, RUN_2 = "timestamp_ntz'2026-01-01 00:00:00'", "timestamp_ntz'2026-02-01 00:00:00'"


def _document_files(spark: SparkSession, sf: str, condition: str = "true") -> DataFrame:
    """The documents table seen as a listing of files."""
    return table(spark, sf, "documents").filter(condition).select(
        "source",
        F.concat(F.lit("/in/"), F.col("doc_id").cast("string"), F.lit(".xml")).alias("source_file_path"),
        F.when(F.col("doc_id") % 4 == 0, F.lit("zip")).otherwise(F.lit("xml")).alias("source_file_type"),
        F.lit(None).cast("string").alias("source_entry_path"),
        F.concat_ws("|", F.col("n_chars").cast("string"), F.lit("0")).alias("fingerprint"),
        "lang",
    )


def _path_sql(alias: str = "doc_id") -> str:
    return f"'/in/' || CAST({alias} AS VARCHAR) || '.xml'"


@query(
    f"""
    SELECT source, {_path_sql()} AS source_file_path, lang FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM documents k WHERE k.doc_id = d.doc_id AND (k.doc_id % 2 = 0 AND k.lang <> 'de'))
    """
)
def ledger_anti_join(spark, sf):
    """A second run over all files when half of them are in the ledger (under an empty entry)."""
    known = _document_files(spark, sf, "doc_id % 2 = 0 and lang <> 'de'")
    ledger = state.ledger_rows(known.withColumn("source_entry_path", F.lit("")), F.expr(RUN_1))
    files = _document_files(spark, sf)
    return state.not_processed(files, ledger).select("source", "source_file_path", "lang")


@query(f"SELECT source, {_path_sql()} AS source_file_path FROM documents WHERE doc_id % 3 <> 0")
def ledger_changed_file(spark, sf):
    """Files that changed since they were processed have another fingerprint and count as new."""
    before = _document_files(spark, sf)
    now = before.withColumn(
        "fingerprint",
        F.when(F.regexp_extract("source_file_path", r"(\d+)", 1).cast("bigint") % 3 != 0, F.concat("fingerprint", F.lit("1")))
        .otherwise(F.col("fingerprint")),
    )
    ledger = state.ledger_rows(before, F.expr(RUN_1))
    return state.not_processed(now, ledger).select("source", "source_file_path")


@query(
    f"""
    SELECT source, {_path_sql()} AS source_file_path,
      CASE WHEN doc_id % 3 = 0 THEN TIMESTAMP '2026-02-01' ELSE TIMESTAMP '2026-01-01' END AS processed_at,
      CASE WHEN doc_id % 3 = 0 THEN '202602' END AS ref_aaaamm,
      CASE WHEN doc_id % 3 = 0 THEN 'redone' ELSE 'ok' END AS status
    FROM documents
    """
)
def ledger_upsert(spark, sf):
    """A batch without months, then single marks with month and status over a third of the keys."""
    files = _document_files(spark, sf)
    first = state.ledger_rows(files, F.expr(RUN_1))
    marked = state.ledger_rows(
        files.filter(F.regexp_extract("source_file_path", r"(\d+)", 1).cast("bigint") % 3 == 0),
        F.expr(RUN_2), F.lit("202602"), "redone", F.lit("note"),
    )
    return state.upsert_ledger(first, first, marked).select(
        "source", "source_file_path", "processed_at", "ref_aaaamm", "status"
    )


@query(f"SELECT source, {_path_sql()} AS source_file_path FROM documents WHERE doc_id % 4 IN (1, 2)")
def ledger_forget_month(spark, sf):
    """Forgetting a month makes exactly the files with that month pending again."""
    files = _document_files(spark, sf)
    number = F.regexp_extract("source_file_path", r"(\d+)", 1).cast("bigint") % 4
    months = F.when(number == 1, "202601").when(number == 2, "202512,202601").when(number == 3, "202512")
    ledger = state.ledger_rows(files, F.expr(RUN_1), months)
    forgotten = state.forget_months(ledger, ["202601"], F.expr(RUN_2))
    return state.not_processed(files, ledger.unionByName(forgotten)).select("source", "source_file_path")


@query(
    f"""
    SELECT source, {_path_sql()} AS source_file_path, CASE WHEN doc_id % 4 = 0 THEN 'zip' ELSE 'xml' END AS source_file_type
    FROM documents WHERE doc_id % 4 = 0 OR lang <> 'en'
    """
)
def quarantine_filter(spark, sf):
    """Loose files in quarantine are skipped, archives are not."""
    files = _document_files(spark, sf)
    bad = files.filter("lang = 'en'").withColumns({"error_type": F.lit("X"), "error_message": F.lit("x")})
    quarantine = state.upsert_quarantine(state.quarantine_rows(bad, F.expr(RUN_1)))
    return state.not_quarantined(files, quarantine).select("source", "source_file_path", "source_file_type")


def _failures(spark: SparkSession, sf: str) -> DataFrame:
    """Error events as failures: the user is the file, a long message, one failure per event."""
    return table(spark, sf, "events").filter("event_type = 'error'").select(
        F.lit("events").alias("source"),
        F.concat(F.lit("/in/"), F.col("user_id").cast("string")).alias("source_file_path"),
        F.lit(None).cast("string").alias("source_entry_path"),
        F.concat(F.lit("fingerprint-of-a-file-number-"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("fingerprint"),
        F.concat(F.lit("E"), (F.col("event_id") % 3).cast("string")).alias("error_type"),
        F.concat(F.col("props"), F.lit(" "), F.repeat(F.lit("x"), 600)).alias("error_message"),
        "ts",
        "event_id",
    )


_QUARANTINE_SQL = """
    SELECT 'fingerprint-of-a-file-number-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS fingerprint,
      '/in/' || CAST(user_id AS VARCHAR) AS source_path,
      arg_max('E' || CAST(event_id % 3 AS VARCHAR), ts) AS error_type,
      arg_max(substr(props || ' ' || repeat('x', 600), 1, 500), ts) AS error_message,
      max(ts) AS failed_at, count(*) AS retry_count
    FROM events WHERE event_type = 'error' GROUP BY user_id
"""


def _quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches of failures: the first aggregated alone, the second added to it."""
    failures = _failures(spark, sf)
    at = F.col("ts")

    def batch(condition: str) -> DataFrame:
        chosen = failures.filter(condition)
        return chosen.select(
            "source", F.col("source_file_path").alias("source_path"), state.entry_key().alias("source_entry_path"),
            "fingerprint", "error_type", F.substring("error_message", 1, 500).alias("error_message"),
            at.cast("timestamp_ntz").alias("failed_at"), F.lit(1).cast("bigint").alias("retry_count"),
        )

    first = state.upsert_quarantine(batch("event_id % 2 = 0"))
    return state.upsert_quarantine(first, batch("event_id % 2 = 1"))


@query(_QUARANTINE_SQL)
def quarantine_upsert(spark, sf):
    return _quarantine(spark, sf).select(
        "fingerprint", "source_path", "error_type", "error_message", "failed_at", "retry_count"
    )


@query(
    f"""SELECT substr(fingerprint, 1, 28) || '..' AS fingerprint, source_path, error_type, error_message, failed_at, retry_count
        FROM ({_QUARANTINE_SQL})"""
)
def quarantine_list(spark, sf):
    return state.list_quarantine(_quarantine(spark, sf))


@query(
    """
    SELECT source, count(*) AS total, count(*) FILTER (WHERE doc_id % 4 <> 0) AS xml, count(*) FILTER (WHERE doc_id % 4 = 0) AS zip
    FROM documents GROUP BY 1
    """
)
def scan_counts(spark, sf):
    return metrics.scan_counts(_document_files(spark, sf))


def _statuses(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.array(*[F.lit(s) for s in metrics.STATUSES])
    return table(spark, sf, "events").select(
        F.col("event_type").alias("source"),
        F.get(kinds, (F.col("event_id") % len(metrics.STATUSES)).cast("int")).alias("status"),
        F.date_format("ts", "yyyyMM").alias("ref_aaaamm"),
    )


@query(
    """
    SELECT event_type AS source, CAST(count_if(event_id % 6 = 0) AS BIGINT) AS ok, CAST(count_if(event_id % 6 = 1) AS BIGINT) AS filtered,
      CAST(count_if(event_id % 6 = 2) AS BIGINT) AS skipped, CAST(count_if(event_id % 6 = 3) AS BIGINT) AS empty, CAST(count_if(event_id % 6 = 4) AS BIGINT) AS no_body,
      CAST(count_if(event_id % 6 = 5) AS BIGINT) AS corrupt,
      array_to_string(list_sort(list(DISTINCT strftime(ts, '%Y%m')) FILTER (WHERE event_id % 6 = 0)), ',') AS months
    FROM events GROUP BY 1
    """
)
def run_summary(spark, sf):
    counts = metrics.outcome_counts(_statuses(spark, sf))
    return counts.withColumn("months", F.array_join("months", ","))


@query("SELECT count_if(event_id % 6 = 5) > 0 AS had_errors FROM events")
def run_failed(spark, sf):
    return metrics.run_failed(metrics.outcome_counts(_statuses(spark, sf)), errors="corrupt")


@query(
    f"""
    SELECT 'current' AS fact, source, {_path_sql()} AS source_file_path,
      CASE WHEN doc_id % 10 = 9 THEN 'forgotten' WHEN doc_id % 10 < 5 THEN 'redone' ELSE 'ok' END AS status
    FROM documents WHERE doc_id % 13 <> 0
    UNION ALL SELECT 'pending', source, {_path_sql()}, NULL FROM documents WHERE doc_id % 13 = 0 OR doc_id % 10 = 9
    """
)
def ledger_many_runs(spark, sf):
    """A ledger of twelve runs, compacted after every four: its state, and the files it leaves to read.

    Each run marks a tenth of the files, two runs mark half of them again, one month is forgotten.
    """
    path, work = scratch(spark, "ledger"), scratch(spark, "compaction")
    number = F.regexp_extract("source_file_path", r"(\d+)", 1).cast("bigint")
    files = _document_files(spark, sf)
    known = files.where(number % 13 != 0)
    for run in range(10):
        at = F.expr(f"timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval({run})")
        month = F.lit("202509" if run == 9 else "202601")
        state.append_state(state.ledger_rows(known.where(number % 10 == run), at, month), path, f"run-{run:02d}")
        state.compact_ledger(spark, path, f"{work}/{run}", after=4)
    for run in (10, 11):
        again = known.where((number % 10 < 5) & (number % 2 == run % 2))
        state.append_state(state.ledger_rows(again, F.expr(RUN_2), F.lit("202602"), "redone"), path, f"run-{run:02d}")
    state.append_state(state.forget_months(state.read_ledger(spark, path), ["202509"], F.expr(RUN_2)), path, "forget-1")
    state.compact_ledger(spark, path, f"{work}/last", after=4)
    ledger = state.read_ledger(spark, path)
    current = state.upsert_ledger(ledger).select(F.lit("current").alias("fact"), "source", "source_file_path", "status")
    pending = state.not_processed(files, ledger)
    return current.union(pending.select(F.lit("pending"), "source", "source_file_path", F.lit(None).cast("string")))


@query(
    """
    SELECT source, '/in/' || coalesce(lang, 'none') || '/' || CAST(doc_id AS VARCHAR) || '.xml' AS source_file_path FROM documents d
    WHERE lang IS NULL OR EXISTS (SELECT 1 FROM documents c WHERE c.source = d.source AND c.lang = d.lang AND c.doc_id % 100 = 7)
    """
)
def ledger_changed_folders(spark, sf):
    """Files of the folders (one per source and language) in which a file has changed since all were known."""
    def listed(changed: str) -> DataFrame:
        files = table(spark, sf, "documents")
        return files.select(
            "source",
            F.concat(F.lit("/in/"), F.coalesce("lang", F.lit("none")), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".xml")).alias("source_file_path"),
            F.concat_ws("|", F.expr(f"if({changed}, n_chars + 1, n_chars)").cast("string"), F.lit("0")).alias("fingerprint"),
        )

    path = scratch(spark, "folders")
    state.note_folders(spark, path, state.folder_listing(listed("lang is null")))
    now = listed("doc_id % 100 = 7")
    changed = state.folder_listing(now).join(state.known_folders(spark, path), ["source", "folder", "files", "one", "two"], "left_anti")
    kept = scratch(spark, "changed")
    changed.write.parquet(kept)
    return state.in_changed_folders(now, spark.read.parquet(kept)).select("source", "source_file_path")


@query("SELECT 'opened' AS reader, count(*) AS n FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 'later', count(*) FROM documents")
def ledger_snapshot(spark, sf):
    """A reader of the ledger sees what was there when it opened it, also after a run and a compaction."""
    path, number = scratch(spark, "snapshot"), F.regexp_extract("source_file_path", r"(\d+)", 1).cast("bigint")
    files = _document_files(spark, sf)
    state.append_state(state.ledger_rows(files.where(number % 2 == 0), F.expr(RUN_1)), path, "run-1")
    opened = state.read_ledger(spark, path)
    state.append_state(state.ledger_rows(files.where(number % 2 == 1), F.expr(RUN_2)), path, "run-2")
    state.compact_ledger(spark, path, scratch(spark, "compaction"), after=2)
    later = state.read_ledger(spark, path)
    return opened.agg(F.lit("opened").alias("reader"), F.count(F.lit(1)).alias("n")).union(
        later.agg(F.lit("later").alias("reader"), F.count(F.lit(1)).alias("n"))
    )
