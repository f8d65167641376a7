from __future__ import annotations

import datetime as dt
import zipfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from xml_samples import invoice, waybill

from tributary.operators import state
from tributary.plans.ingest import IngestOptions, Source, forget, ingest
from tributary.schemas import CTE_SCHEMA, LEDGER_SCHEMA, NFE_SCHEMA, QUARANTINE_SCHEMA
from tributary.sinks.monthly import read_months
from tributary.sources.archives import list_entries, read_entries
from tributary.sources.files import list_files
from tributary.streaming.available_now import ingest_stream

NOW = dt.datetime(2026, 2, 26, 7)


def zip_of(path, members, **options):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, **options) as archive:
        for name, content in members:
            archive.writestr(name, content)


@pytest.fixture()
def inputs(tmp_path):
    a, b = tmp_path / "importados", tmp_path / "processados"
    (a / "sub").mkdir(parents=True)
    b.mkdir()
    (a / "one.xml").write_bytes(invoice(key="A" * 44))
    (a / "sub" / "two.xml").write_bytes(invoice(key="B" * 44, issued="2026-01-10T10:00:00-03:00"))
    (a / "old.xml").write_bytes(invoice(key="C" * 44, issued="2025-06-10T10:00:00-03:00"))
    (a / "bad.xml").write_bytes(b"<nfe>TRUNC")
    (a / "empty.xml").write_bytes(b"  ")
    (a / "UPPER.XML").write_bytes(invoice(key="D" * 44))
    (a / "way.xml").write_bytes(waybill())
    zip_of(b / "z.zip", [("x/n.xml", invoice(key="E" * 44)), ("c.xml", waybill()), ("bad.xml", b"<a>"), ("n.txt", b"")])
    zip_of(b / "evil.zip", [("../e.xml", invoice())])
    (b / "broken.zip").write_bytes(b"PK\x03\x04nope")
    return tmp_path


def options(base, **changes):
    made = IngestOptions(
        sources=(
            Source("importados", str(base / "importados"), str(base / "out/importados")),
            Source("processados", str(base / "processados"), str(base / "out/processados"), str(base / "out/cte")),
        ),
        state_path=str(base / "state"),
        now=NOW,
    )
    return replace(made, **changes)


def counts(result):
    return {r["source"]: r.asDict() for r in result.counts.collect()}


def keys(spark, path, schema, column):
    return sorted(r[0][:1] for r in read_months(spark, str(path), schema).select(column).collect())


def test_run_then_nothing_new_then_forget(spark, inputs):
    o = options(inputs)
    first = ingest(spark, o)
    assert first.had_errors is False and first.months == ["202601", "202602"]
    c = counts(first)
    assert {k: c["importados"][k] for k in ("total", "xml", "zip", "ok", "filtered", "empty", "no_body", "corrupt")} == {
        "total": 6, "xml": 6, "zip": 0, "ok": 2, "filtered": 1, "empty": 1, "no_body": 1, "corrupt": 1}
    assert c["importados"]["months"] == ["202601", "202602"]
    assert {k: c["processados"][k] for k in ("total", "zip", "ok", "corrupt")} == {
        "total": 3, "zip": 3, "ok": 2, "corrupt": 3}
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A", "B"]
    assert keys(spark, inputs / "out/processados", NFE_SCHEMA, "chNFe") == ["E"]
    way = read_months(spark, str(inputs / "out/cte"), CTE_SCHEMA).collect()
    assert [(r.chCTe[:1], r.source, r.source_entry_path, r.source_file_type) for r in way] == [
        ("2", "processados_cte", "c.xml", "zip")]
    assert {r.ingested_at for r in way} == {NOW}
    modified = dt.datetime.fromtimestamp((inputs / "processados/z.zip").stat().st_mtime, dt.timezone.utc)
    assert abs(way[0].source_file_mtime - modified.replace(tzinfo=None)) < dt.timedelta(seconds=1)
    assert read_months(spark, str(inputs / "out/importados_flat"), None).count() == 24
    assert read_months(spark, str(inputs / "out/cte_flat"), None).count() == 8

    ledger = state.read_ledger(spark, o.ledger_path).collect()
    assert {(r.source_file_path.rsplit("/", 1)[1], r.ref_aaaamm) for r in ledger} == {
        ("one.xml", "202602"), ("two.xml", "202601"), ("old.xml", None), ("way.xml", None), ("z.zip", "202602")}
    quarantine = state.read_quarantine(spark, o.quarantine_path).collect()
    assert {(r.source_path.rsplit("/", 1)[1], r.source_entry_path, r.error_type) for r in quarantine} == {
        ("bad.xml", "", "XMLSyntaxError"), ("z.zip", "bad.xml", "XMLSyntaxError"),
        ("evil.zip", "", "ValueError"), ("broken.zip", "", "BadZipFile")}

    (inputs / "importados" / "three.xml").write_bytes(invoice(key="F" * 44))
    second = ingest(spark, replace(o, now=NOW + dt.timedelta(hours=1)))
    c = counts(second)
    assert c["importados"]["ok"] == 1 and c["importados"]["corrupt"] == 0 and c["processados"]["ok"] == 0
    # Of seven files four are in the ledger and one is in quarantine; of three archives one is known.
    assert (c["importados"]["total"], c["importados"]["skipped"]) == (7, 5)
    assert (c["processados"]["total"], c["processados"]["skipped"]) == (3, 1)
    # Merging keeps the documents that were stored before.
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A", "B", "F"]
    retries = {r.source_path.rsplit("/", 1)[1]: r.retry_count for r in state.read_quarantine(spark, o.quarantine_path).collect()}
    assert retries == {"bad.xml": 1, "z.zip": 1, "evil.zip": 2, "broken.zip": 2}

    later = replace(o, now=NOW + dt.timedelta(hours=2))
    forget(spark, later, ["202601"])
    third = ingest(spark, replace(o, now=NOW + dt.timedelta(hours=3)))
    assert counts(third)["importados"]["ok"] == 1 and third.months == ["202601"]


def test_replace_keeps_only_new_documents(spark, inputs):
    o = options(inputs, mode="replace", flatten=False)
    ingest(spark, o)
    (inputs / "importados" / "three.xml").write_bytes(invoice(key="F" * 44))
    ingest(spark, replace(o, now=NOW + dt.timedelta(hours=1)))
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["B", "F"]


def test_strict_archives_and_missing_source(spark, inputs):
    o = options(inputs, strict_archives=True, flatten=False)
    o = replace(o, sources=o.sources + (Source("gone", str(inputs / "gone"), str(inputs / "out/gone")),))
    result = ingest(spark, o)
    assert result.had_errors is True and result.missing_sources == ("gone",)
    # Tables are written, but files of the failed source are not marked as processed.
    assert keys(spark, inputs / "out/processados", NFE_SCHEMA, "chNFe") == ["E"]
    assert {r.source for r in state.read_ledger(spark, o.ledger_path).collect()} == {"importados"}


def test_archives_without_documents_and_unreadable_files(spark, inputs):
    zip_of(inputs / "processados" / "none.zip", [("readme.txt", b"x")])
    (inputs / "importados" / "gone.xml").symlink_to(inputs / "importados" / "nowhere.xml")
    (inputs / "importados" / "_hidden.xml").write_bytes(invoice(key="H" * 44))
    o = options(inputs, flatten=False)
    with pytest.raises(OSError):
        list_files(spark, str(inputs / "nowhere"), "importados")
    first = ingest(spark, o)
    assert counts(first)["importados"]["total"] == 8 and first.had_errors
    assert counts(first)["importados"]["errors"] == 1 and counts(first)["processados"]["errors"] == 0
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A", "B", "H"]
    names = {r.source_file_path.rsplit("/", 1)[1] for r in state.read_ledger(spark, o.ledger_path).collect()}
    assert "none.zip" in names and "_hidden.xml" in names and "gone.xml" not in names
    assert counts(ingest(spark, replace(o, now=NOW + dt.timedelta(hours=1))))["processados"]["skipped"] == 2


def test_a_file_that_cannot_be_read_is_an_error_and_the_others_go_on(spark, inputs, monkeypatch):
    from tributary.plans import ingest as plan

    listed = plan.list_files

    def with_vanished(*args):
        files = listed(*args)
        return files.withColumn("source_file_path", F.regexp_replace("source_file_path", "one.xml$", "vanished.xml"))

    monkeypatch.setattr(plan, "list_files", with_vanished)
    o = options(inputs, flatten=False)
    result = ingest(spark, o)
    assert result.had_errors and counts(result)["importados"]["errors"] == 1
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["B"]
    names = {r.source_file_path.rsplit("/", 1)[1] for r in state.read_ledger(spark, o.ledger_path).collect()}
    assert "two.xml" in names and "vanished.xml" not in names
    held = {r.source_path.rsplit("/", 1)[1] for r in state.read_quarantine(spark, o.quarantine_path).collect()}
    assert "vanished.xml" not in held


def test_a_run_that_breaks_while_writing_leaves_the_version_before_it(spark, inputs, monkeypatch):
    from tributary.sinks import versions

    o = options(inputs, flatten=False)
    ingest(spark, o)
    (inputs / "importados" / "three.xml").write_bytes(invoice(key="F" * 44))

    def breaks(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", breaks)
        with pytest.raises(KeyboardInterrupt):
            ingest(spark, replace(o, now=NOW + dt.timedelta(hours=1)))
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A", "B"]
    left = len(list((inputs / "out/importados/_data").iterdir()))
    ingest(spark, replace(o, now=NOW + dt.timedelta(hours=2)))
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A", "B", "F"]
    # What the broken run left is gone, the version before stays readable.
    assert (left, len(list((inputs / "out/importados/_data").iterdir()))) == (2, 2)


def test_all_methods_and_charsets_of_members(spark, tmp_path):
    texts = {
        "big5": "<?xml version='1.0' encoding='Big5'?><NFe><infNFe Id='NFe1'><ide><natOp>中文</natOp></ide></infNFe></NFe>",
        "koi8-r": "<?xml version='1.0' encoding='KOI8-R'?><NFe><infNFe Id='NFe1'><ide><natOp>дом</natOp></ide></infNFe></NFe>",
    }
    (tmp_path / "in").mkdir()
    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA):
        with zipfile.ZipFile(tmp_path / "in" / f"{method}.zip", "w", method) as archive:
            for charset, text in texts.items():
                archive.writestr(f"{charset}.xml", text.encode(charset))
    entries = list_entries(list_files(spark, str(tmp_path / "in"), "s"))
    rows = read_entries(entries, 2).select("content", "error_type").collect()
    assert len(rows) == 8 and {r.error_type for r in rows} == {None}
    assert {w for r in rows for w in ("中文", "дом") if w in bytes(r.content).decode("utf-8-sig")} == {"中文", "дом"}


def test_unknown_mode_is_refused(inputs):
    with pytest.raises(ValueError):
        options(inputs, mode="append")


def test_stream_gives_the_same_tables(spark, inputs):
    o = options(inputs)
    ingest_stream(spark, o, str(inputs / "checkpoint"), files_per_batch=4)
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A", "B"]
    assert keys(spark, inputs / "out/processados", NFE_SCHEMA, "chNFe") == ["E"]
    (inputs / "importados" / "three.xml").write_bytes(invoice(key="F" * 44))
    ingest_stream(spark, o, str(inputs / "checkpoint"), files_per_batch=4)
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A", "B", "F"]


@pytest.mark.parametrize("broken", [False, True])
def test_a_stream_call_flattens_once_after_its_batches(spark, inputs, monkeypatch, broken):
    from types import SimpleNamespace

    from tributary.streaming import available_now

    done = []

    def batch(session, made, files):
        done.append(("batch", made.flatten))
        if broken:
            raise OSError("lost")
        return SimpleNamespace(had_errors=False)

    def flatten(session, tables, window):
        done.append(("flat", [kind for _, kind in tables]))
        return False

    monkeypatch.setattr(available_now, "ingest", batch)
    monkeypatch.setattr(available_now, "flatten_tables", flatten)
    checkpoint = inputs / "checkpoint"
    files = list_files(spark, str(inputs / "importados"), "importados")
    for name in ("one", "two"):  # a table of the queue each
        available_now.queue_files(spark, files.where(f"source_file_path like '%/{name}.xml'"), str(checkpoint / "queue"))
    o = replace(options(inputs), sources=(Source("importados", str(inputs / "importados" / "sub"), "t"),))
    if broken:
        with pytest.raises(Exception, match="lost"):
            ingest_stream(spark, o, str(checkpoint))
    else:
        ingest_stream(spark, o, str(checkpoint))
    assert done == [("batch", False)] * (1 if broken else 2) + [("flat", ["nfe"])]


# ------------------------------------------------------------------ files and archives


def test_listing_does_not_read_contents(spark, inputs):
    files = list_files(spark, str(inputs / "importados"), "importados")
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    row = files.filter("source_file_path like '%/one.xml'").first()
    size = (inputs / "importados" / "one.xml").stat().st_size
    assert row.fingerprint.startswith(f"{size}|") and row.source_file_type == "xml"


def test_a_large_archive_is_read_by_many_tasks(spark, tmp_path):
    import tributary.sources.archives as A

    members = [(f"d/{i}.xml", f"<a>{i}{'x' * 2000}</a>".encode()) for i in range(500)]
    members += [("d/7.xml", b"<a>last one counts</a>")]
    with pytest.warns(UserWarning):
        zip_of(tmp_path / "big.zip", members)
    with zipfile.ZipFile(tmp_path / "stored.zip", "w") as archive:
        archive.writestr("s.xml", b"<a>stored</a>")
    old, A.SLICE_BYTES = A.SLICE_BYTES, 2000
    try:
        entries = list_entries(list_files(spark, str(tmp_path), "s"))
        rows = read_entries(entries, 8).select(
            "source_entry_path", "content", F.spark_partition_id().alias("p"), "error_type").collect()
    finally:
        A.SLICE_BYTES = old
    assert len(rows) == 501 and all(r.error_type is None for r in rows)
    by_name = {r.source_entry_path: bytes(r.content) for r in rows}
    assert by_name["d/7.xml"] == b"<a>last one counts</a>" and by_name["s.xml"] == b"<a>stored</a>"
    assert by_name["d/499.xml"] == members[499][1]
    assert len({r.p for r in rows}) > 4


@pytest.mark.parametrize("portion", [1, 3, 20_000])
@pytest.mark.parametrize("in_front", [b"", b"#!/bin/sh\n"])
def test_directories_are_cut_and_equal_the_librarys(spark, tmp_path, monkeypatch, portion, in_front):
    """Any cut of a directory gives the members that the library lists: repeated names, folders, long comments."""
    import tributary.sources.archives as A

    monkeypatch.setattr(A, "ENTRIES_PER_PORTION", portion)
    monkeypatch.setattr(A, "DIRECTORY_BUFFER", 70)
    members = [(f"d{i % 3}/./{i % 7}.xml", b"<a>%d</a>" % i) for i in range(23)] + [("ü.xml", b"<u/>"), ("folder/", b""), ("n.txt", b"n")]
    with pytest.warns(UserWarning):
        zip_of(tmp_path / "a.zip", members)
    with zipfile.ZipFile(tmp_path / "a.zip", "a") as archive:
        archive.comment = b"PK\x05 a comment " * 200
    zip_of(tmp_path / "none.zip", [(f"{i}.txt", b"") for i in range(5)])
    zip_of(tmp_path / "evil.zip", [("a.xml", b"<a/>"), ("b.xml", b"<b/>"), ("../e.xml", b"<e/>"), ("c.xml", b"<c/>"), ("d.txt", b"")])
    (tmp_path / "broken.zip").write_bytes(b"PK\x05\x06" + b"\xff" * 30)
    (tmp_path / "void.zip").write_bytes(b"PK\x05\x06" + bytes(18))
    if in_front:
        (tmp_path / "a.zip").write_bytes(in_front + (tmp_path / "a.zip").read_bytes())
    with zipfile.ZipFile(tmp_path / "a.zip") as archive:
        expected = {n.replace("/./", "/"): archive.read(n) for n in archive.namelist() if n.endswith(".xml")}
    files = list_files(spark, str(tmp_path), "s")
    for work in (None, str(tmp_path / "work")):
        rows = read_entries(list_entries(files, 2, work), 2).collect()
        found = {}
        for r in rows:
            found.setdefault(r.source_file_path.rsplit("/", 1)[1], []).append(r)
        assert {r.source_entry_path: bytes(r.content) for r in found["a.zip"]} == expected and len(found["a.zip"]) == len(expected)
        assert [(r.method, r.error_type) for n in ("none.zip", "void.zip") for r in list_entries(files, 2, work).where(
            F.col("source_file_path").endswith(n)).collect()] == [(A.NO_DOCUMENTS, None)] * 2
        assert [r.error_type for r in found["evil.zip"]] == ["ValueError"] and [r.error_type for r in found["broken.zip"]] == ["BadZipFile"]


def test_archives_with_more_members_than_the_format_first_had_room_for(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "many.zip", "w") as archive:
        for i in range(66_000):
            archive.writestr(f"{i}.xml" if i % 600 == 0 else f"{i}.txt", b"")
    entries = list_entries(list_files(spark, str(tmp_path), "s"), 1, str(tmp_path / "work"))
    assert sorted(int(r[0][:-4]) for r in entries.select("source_entry_path").collect()) == list(range(0, 66_000, 600))
    portions = spark.read.parquet(str(tmp_path / "work/portions"))
    assert portions.count() == 4


def test_a_closed_folder_is_an_error_of_its_source_and_the_rest_goes_on(spark, inputs, monkeypatch):
    """Root may look into any folder, so the listing itself is made to fail for one."""
    from tributary.sources import files as sources

    inside = sources._inside

    def closed(folder):
        if folder.endswith("/sub"):
            raise PermissionError(13, "closed", folder)
        return inside(folder)

    monkeypatch.setattr(sources, "_inside", closed)
    o = options(inputs, flatten=False)
    result = ingest(spark, o)
    assert result.had_errors and counts(result)["importados"]["errors"] == 1 and counts(result)["processados"]["errors"] == 0
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A"]
    monkeypatch.setattr(sources, "_inside", inside)
    ingest(spark, replace(o, now=NOW + dt.timedelta(hours=1)))
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A", "B"]


def test_the_ledger_is_compacted_and_unchanged_folders_are_not_looked_up(spark, inputs, monkeypatch):
    monkeypatch.setattr(state, "RUNS_BEFORE_COMPACTION", 2)
    monkeypatch.setattr(state.compact_ledger, "__defaults__", (2,))
    o = options(inputs, flatten=False)
    asked = []
    read = state.read_ledger

    def watched(spark, path, parts=None):
        asked.append(parts)
        return read(spark, path, parts)

    monkeypatch.setattr(state, "read_ledger", watched)
    for run in range(5):
        if run == 3:
            (inputs / "importados" / "sub" / "three.xml").write_bytes(invoice(key="F" * 44))
        ingest(spark, replace(o, now=NOW + dt.timedelta(hours=run)))
    # Folders with retried archives and with files that stay empty are looked up each time, settled ones are not.
    assert len(asked) == 5 and len(asked[3]) >= len(asked[4])
    names = sorted(r[0].rsplit("/", 1)[1] for r in read(spark, o.ledger_path).select("source_file_path").distinct().collect())
    assert names == ["old.xml", "one.xml", "three.xml", "two.xml", "way.xml", "z.zip"]
    assert (inputs / "state/ledger/_base/_manifest").exists()
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A", "B", "F"]


def test_damaged_member_does_not_lose_the_archive(spark, tmp_path):
    zip_of(tmp_path / "z.zip", [("a.xml", b"<a>" + bytes(range(32, 127)) * 20 + b"</a>"), ("b.xml", b"<b/>")])
    data = bytearray((tmp_path / "z.zip").read_bytes())
    data[60] ^= 0xFF
    (tmp_path / "z.zip").write_bytes(bytes(data))
    rows = read_entries(list_entries(list_files(spark, str(tmp_path), "s")), 2).collect()
    found = {r.source_entry_path: (r.content is not None, r.error_type) for r in rows}
    assert found["b.xml"] == (True, None)
    assert found["a.xml"][0] is False and found["a.xml"][1] in ("BadZipFile", "error")


# ------------------------------------------------------------------ state


def ledger(spark, *rows):
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def files(spark, *rows):
    return spark.createDataFrame(rows, "source string, source_file_path string, source_entry_path string, fingerprint string, source_file_type string")


def test_membership(spark):
    known = ledger(spark, ("a", "/f", "", "1|2", NOW, None, "ok", None))
    rows = files(
        spark, ("a", "/f", None, "1|2", "xml"), ("b", "/f", None, "1|2", "xml"), ("a", "/f", None, "1|3", "xml"),
        ("a", "/g", None, "1|2", "xml"), ("a", "/f", "e", "1|2", "zip"))
    left = state.not_processed(rows, known).collect()
    assert sorted((r.source, r.source_file_path, r.source_entry_path, r.fingerprint) for r in left if r.source_entry_path is None) == [
        ("a", "/f", None, "1|3"), ("a", "/g", None, "1|2"), ("b", "/f", None, "1|2")]
    assert len(left) == 4


def test_ledger_upsert_and_snapshot(spark, tmp_path):
    row = ("a", "/f", None, "1|2", NOW, None, "ok", None)
    again = ("a", "/f", "", "1|2", NOW + dt.timedelta(days=1), "202602", "ok", "n")
    merged = state.upsert_ledger(ledger(spark, row), ledger(spark, row, again)).collect()
    assert [(r.source_entry_path, r.ref_aaaamm, r.notes) for r in merged] == [("", "202602", "n")]
    path = str(tmp_path / "ledger")
    assert state.read_ledger(spark, path).count() == 0
    state.append_state(ledger(spark, row), path, "r1")
    snapshot = state.read_ledger(spark, path)
    state.append_state(ledger(spark, ("a", "/g", "", "1|2", NOW, None, "ok", None)), path, "r2")
    assert snapshot.select("source_file_path").distinct().count() == 1
    state.append_state(ledger(spark, row), path, "r1")
    assert state.read_ledger(spark, path).count() == 2


def test_quarantine_counts_attempts_and_cuts_messages(spark):
    def failure(kind, message, at):
        return ("a", "/f", "", "x" * 40, kind, message, at, 1)

    old = spark.createDataFrame([failure("E1", "m", NOW)], QUARANTINE_SCHEMA)
    new = spark.createDataFrame([failure("E2", "y" * 1000, NOW + dt.timedelta(days=1))], QUARANTINE_SCHEMA)
    row = state.upsert_quarantine(state.upsert_quarantine(old), new).first()
    assert (row.retry_count, row.error_type, len(row.error_message)) == (2, "E2", 500)
    assert state.list_quarantine(state.upsert_quarantine(old)).first().fingerprint == "x" * 28 + ".."
    held = state.not_quarantined(
        files(spark, ("a", "/f", None, "x" * 40, "xml"), ("a", "/f", None, "x" * 40, "zip"), ("a", "/h", None, "x" * 40, "xml")),
        state.upsert_quarantine(old))
    assert sorted((r.source_file_path, r.source_file_type) for r in held.collect()) == [("/f", "zip"), ("/h", "xml")]


def test_files_of_equal_texts_take_one_place_on_disk(spark, tmp_path, monkeypatch):
    """Nine million files of four bytes took a block of the disk each."""
    from tributary.queries import packing
    from tributary.sources.files import list_files

    def write(rows, folder, shared):
        df = spark.createDataFrame(rows, "entry string, text string")
        return packing.write_files(df, str(tmp_path / folder), 1, shared=shared)

    rows = [(f"{n % 3}/{n}.xml", "<a/>" if n < 40 else f"<b>{n}</b>") for n in range(42)] + [("0/0.xml", "<a/>")]
    for attempt in range(2):  # a repeated task finds the names of the first attempt
        assert write(rows, "shared", True) == write(rows, "single", False) == 43
    places = {name: {f.stat().st_ino for f in (tmp_path / name).rglob("*.xml")} for name in ("shared", "single")}
    assert len(places["single"]) == 42 and len(places["shared"]) <= 5
    texts = {name: {str(f.relative_to(tmp_path / name)): f.read_text() for f in (tmp_path / name).rglob("*.xml")} for name in ("shared", "single")}
    assert texts["shared"] == texts["single"] == dict(rows)
    listed = [list_files(spark, str(tmp_path / name), "s", str(tmp_path / f"work-{name}")) for name in ("shared", "single")]
    assert [sorted(r["length"] for r in files.collect()) for files in listed][0] == sorted(len(t) for t in dict(rows).values())
    assert listed[0].count() == listed[1].count() == 42


def test_batches_are_merged_once_and_wait_for_the_next_call_if_that_fails(spark, inputs, monkeypatch):
    from tributary.plans import ingest as plan
    from tributary.streaming import available_now

    merged, merge = [], plan.merge_version

    def lost(session, path, *args, **kwargs):
        raise OSError("lost")

    def counted(session, path, *args, **kwargs):
        merged.append(path)
        return merge(session, path, *args, **kwargs)

    o = options(inputs, flatten=False)
    o, checkpoint = replace(o, sources=o.sources[:1]), inputs / "checkpoint"
    files = list_files(spark, o.sources[0].root, "importados")
    for some in ("like", "not like"):  # a table of the queue each
        available_now.queue_files(spark, files.where(f"source_file_path {some} '%/one.xml'"), f"{checkpoint}/queue")
    monkeypatch.setattr(plan, "merge_version", lost)
    with pytest.raises(RuntimeError, match="could not be merged"):
        ingest_stream(spark, o, str(checkpoint))
    assert state.known_files(state.read_ledger(spark, o.ledger_path)).count() == 0
    monkeypatch.setattr(plan, "merge_version", counted)
    ingest_stream(spark, o, str(checkpoint))
    assert merged == [str(inputs / "out/importados")]
    assert keys(spark, inputs / "out/importados", NFE_SCHEMA, "chNFe") == ["A", "B"]
    ledger = state.known_files(state.read_ledger(spark, o.ledger_path)).select("source_file_path").collect()
    assert sorted(r[0].rsplit("/", 1)[1] for r in ledger) == ["old.xml", "one.xml", "two.xml", "way.xml"]
    held = state.read_quarantine(spark, o.quarantine_path).select("source_path", "retry_count").collect()
    assert [(r[0].rsplit("/", 1)[1], r[1]) for r in held] == [("bad.xml", 1)]
    assert not (checkpoint / "staged").exists()


def test_merging_waits_no_longer_than_its_bytes(spark, inputs, monkeypatch):
    from types import SimpleNamespace

    from tributary.streaming import available_now

    done = []
    monkeypatch.setattr(available_now, "ingest", lambda session, made, files: done.append("batch") or SimpleNamespace(had_errors=False))
    monkeypatch.setattr(available_now, "staged_bytes", lambda *args: available_now.BYTES_PER_MERGE // 2)
    monkeypatch.setattr(available_now, "settle", lambda *args: bool(done.append("merge")))
    files = list_files(spark, str(inputs / "importados"), "importados")
    for name in ("one", "two", "old"):
        available_now.queue_files(spark, files.where(f"source_file_path like '%/{name}.xml'"), str(inputs / "checkpoint" / "queue"))
    o = options(inputs, flatten=False)
    ingest_stream(spark, replace(o, sources=(Source("importados", str(inputs / "importados" / "sub"), "t"),)), str(inputs / "checkpoint"))
    assert done == ["merge", "batch", "batch", "merge", "batch", "merge"]
