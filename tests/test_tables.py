from __future__ import annotations

import datetime as dt
from decimal import Decimal
from math import prod

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F, types as T

from tributary import fields as X
from tributary.operators.compact import concat_parts, keep_latest, keep_latest_narrow, keep_statistics, merge_months
from tributary.operators.flatten import flat_schema, flatten, flatten_freight, flatten_invoices
from tributary.operators.rules import month_window, within_rules
from tributary.plans.flat_tables import flat_path, flatten_tables, months_to_flatten
from tributary.schemas import CTE_SCHEMA, NFE_SCHEMA
from tributary.sinks.monthly import read_months, write_months

T0 = dt.datetime(2026, 1, 30, 23, 59)
T1 = dt.datetime(2026, 2, 3, 4, 5)


def nfe_row(**values):
    return tuple(values.get(f.name) for f in NFE_SCHEMA)


def nfe(spark, *rows):
    return spark.createDataFrame([nfe_row(**r) for r in rows], NFE_SCHEMA)


def sized(n_items, n_dup, n_pag, n_warn, key="K"):
    return {
        "chNFe": key, "ref_aaaamm": "202602", "source": "importados",
        "itens_cProd": [f"P{i}" for i in range(n_items)],
        "itens_qCom": [Decimal(i + 1) for i in range(n_items)],
        "dup_nDup": [f"{i:03d}" for i in range(n_dup)],
        "dup_dVenc": [dt.date(2026, 3, 1 + i) for i in range(n_dup)],
        "pag_tPag": ["15"] * n_pag,
        "parser_warnings": [f"w{i}" for i in range(n_warn)] or None,
    }


# ------------------------------------------------------------------ rules


@pytest.mark.parametrize("now, n, expected", [
    (dt.date(2024, 12, 31), 1, ["202412"]),
    (dt.date(2023, 3, 8), 4, ["202303", "202302", "202301", "202212"]),
    (dt.date(2024, 2, 29), 0, []),
])
def test_month_window(now, n, expected):
    assert month_window(now, n) == expected


@given(st.dates(dt.date(1990, 1, 1), dt.date(2090, 12, 31)), st.integers(1, 40))
def test_month_window_is_a_run_of_months(now, n):
    months = month_window(now, n)
    numbers = [int(m[:4]) * 12 + int(m[4:]) for m in months]
    assert months[0] == f"{now:%Y%m}" and numbers == list(range(numbers[0], numbers[0] - n, -1))


def test_rules_drop_unknown_dates(spark):
    df = spark.createDataFrame(
        [(1, 2026, "202602"), (2, 2025, "202602"), (3, None, "202602"), (4, 2026, None), (5, 2026, "202601")],
        "id int, ano_emissao int, ref_aaaamm string",
    )
    assert [r.id for r in df.filter(within_rules(2026, ["202602"])).collect()] == [1]
    assert df.filter(within_rules(2026, [])).count() == 0


# ------------------------------------------------------------------ compaction


@pytest.mark.parametrize("older, newer", [
    ({"source_file_mtime": T0}, {"source_file_mtime": T1}),
    ({"source_file_mtime": None}, {"source_file_mtime": T0}),
    ({"source_file_mtime": T1, "ingested_at": T0}, {"source_file_mtime": T1, "ingested_at": T1}),
    ({"source_file_path": "/a"}, {"source_file_path": "/b"}),
    ({"source_entry_path": None}, {"source_entry_path": "x.xml"}),
])
def test_newest_copy_wins(spark, older, newer):
    base = {"chNFe": "K", "source": "s", "ref_aaaamm": "202602"}
    df = nfe(spark, {**base, **older, "nNF": "old"}, {**base, **newer, "nNF": "new"})
    assert [r.nNF for r in keep_latest(df, "chNFe").collect()] == ["new"]
    narrow = df.select("chNFe", "source", "ref_aaaamm", "nNF", "source_file_mtime", "ingested_at",
                       "source_file_path", "source_entry_path")
    assert [r.nNF for r in keep_latest_narrow(narrow, "chNFe").collect()] == ["new"]


def test_keys_are_kept_apart_by_source_and_month(spark):
    rows = [{"chNFe": "K", "source": s, "ref_aaaamm": m} for s in "ab" for m in ("202601", "202602")]
    assert keep_latest(nfe(spark, *rows, *rows), "chNFe").count() == 4


def test_rows_without_key_are_dropped_and_counted_apart(spark):
    base = {"source": "s", "ref_aaaamm": "202602"}
    df = nfe(spark, *[{**base, "chNFe": k} for k in ("A", "A", "B", None, None)])
    assert sorted(r.chNFe for r in keep_latest(df, "chNFe").collect()) == ["A", "B"]
    row = keep_statistics(df, "chNFe").first()
    assert (row.rows_before, row.rows_after, row.null_keys, row.dupes_removed) == (5, 2, 2, 1)


def test_keep_latest_limits_rows_before_the_shuffle(spark):
    df = nfe(spark, {"chNFe": "A", "source": "s", "ref_aaaamm": "202602"})
    plan = keep_latest(df, "chNFe")._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_concat_keeps_copies(spark):
    df = nfe(spark, {"chNFe": "A"}, {"chNFe": "B"})
    assert concat_parts(df, df, df).count() == 6


# ------------------------------------------------------------------ unnesting


SIZES = [(i, d, p, w) for i in (0, 1, 3) for d in (0, 5) for p in (0, 2) for w in (0, 4)]


def test_flat_rows_are_the_product_of_the_group_sizes(spark):
    flat = flatten_invoices(nfe(spark, *[sized(*s, key=str(s)) for s in SIZES]))
    found = {r["chNFe"]: r for r in flat.groupBy("chNFe").agg(F.count("*").alias("n"), F.min_by("itens_cProd", "item_seq").alias("first")).collect()}
    for sizes in SIZES:
        row = found[str(sizes)]
        assert row["n"] == prod(max(1, s) for s in sizes)
        assert row["first"] == ("P0" if sizes[0] else None)


def test_flat_schema(spark):
    df = nfe(spark, sized(1, 1, 1, 1))
    schema = flatten_invoices(df).schema
    assert len(schema) == 86
    assert schema["item_seq"].dataType == T.ShortType()
    names = schema.fieldNames()
    assert names.index("item_seq") == names.index("itens_ICMS15_vICMSMonoReten") + 1
    assert "parser_warnings" in names and schema["dup_dVenc"].dataType == T.DateType()
    assert [(f.name, f.dataType) for f in schema] == [
        (f.name, f.dataType) for f in flat_schema(NFE_SCHEMA, X.NFE_LIST_GROUPS, "itens")
    ]
    freight = spark.createDataFrame([], CTE_SCHEMA)
    assert len(flatten_freight(freight).schema) == 43 and flatten_freight(freight).count() == 0


def test_freight_rows_are_the_product_of_the_group_sizes(spark):
    rows = []
    for q, n, v, w in SIZES:
        values = {
            "chCTe": str((q, n, v, w)), "infQ_qCarga": [Decimal(i) for i in range(q)], "infNFe_chave": [str(i) for i in range(n)],
            "transp_qVol": [Decimal(i) for i in range(v)], "parser_warnings": [f"w{i}" for i in range(w)] or None,
        }
        rows.append(tuple(values.get(f.name) for f in CTE_SCHEMA))
    found = flatten_freight(spark.createDataFrame(rows, CTE_SCHEMA)).groupBy("chCTe").count().collect()
    assert {r["chCTe"]: r["count"] for r in found} == {str(s): prod(max(1, k) for k in s) for s in SIZES}


def test_short_and_missing_lists(spark):
    df = spark.createDataFrame(
        [(1, [1, 2, 3], ["a"]), (2, None, ["b"]), (3, [], None)], "id int, a array<int>, b array<string>"
    )
    flat = flatten(df, {"g": ["a", "b", "gone"], "h": ["none"]}, sequence_group="g", sequence_column="n")
    assert sorted(map(tuple, flat.select("id", "n", "a", "b").collect()), key=str) == sorted(
        [(1, 1, 1, "a"), (1, 2, 2, None), (1, 3, 3, None), (2, 1, None, "b"), (3, None, None, None)], key=str
    )


def test_flattening_does_not_shuffle(spark):
    plan = flatten_invoices(nfe(spark, sized(1, 1, 1, 1)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


# ------------------------------------------------------------------ stored months


def test_months_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [{**sized(1, 0, 0, 0, key=m), "ref_aaaamm": m} for m in ("202601", "202602")]
    write_months(nfe(spark, *rows), path, sort_by="chNFe")
    write_months(nfe(spark, {**rows[1], "chNFe": "new"}), path, sort_by="chNFe")
    stored = read_months(spark, path, NFE_SCHEMA)
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in NFE_SCHEMA]
    assert sorted((r.ref_aaaamm, r.chNFe) for r in stored.collect()) == [("202601", "202601"), ("202602", "new")]
    assert read_months(spark, path, None, ["202601"]).count() == 1
    files = list((tmp_path / "table").rglob("*.parquet"))
    assert files and all("zstd" in f.name for f in files)


def test_merge_into_the_month_that_is_read(spark, tmp_path):
    path = str(tmp_path / "table")
    write_months(nfe(spark, {**sized(1, 0, 0, 0, "A"), "nNF": "1", "ingested_at": T0}, sized(1, 0, 0, 0, "B")), path)
    new = nfe(spark, {**sized(1, 0, 0, 0, "A"), "nNF": "2", "ingested_at": T1}, sized(1, 0, 0, 0, "C"))
    merged = merge_months(read_months(spark, path, NFE_SCHEMA, ["202602"]), new, "chNFe")
    write_months(merged, path, sort_by="chNFe")
    rows = read_months(spark, path, NFE_SCHEMA).collect()
    assert sorted(r.chNFe for r in rows) == ["A", "B", "C"]
    assert {r.chNFe: r.nNF for r in rows}["A"] == "2"


def test_flat_tables_follow_their_source(spark, tmp_path):
    path = str(tmp_path / "table")
    window = ["202602", "202601"]
    assert flatten_tables(spark, [(path, "nfe")], window) is False
    rows = [{**sized(2, 2, 1, 0, key=m), "ref_aaaamm": m} for m in ("202512", "202601", "202602")]
    write_months(nfe(spark, *rows), path)
    assert months_to_flatten(spark, path, window) == ["202601", "202602"]
    assert flatten_tables(spark, [(path, "nfe")], window) is False
    assert months_to_flatten(spark, path, window) == []
    flat = read_months(spark, flat_path(path), None)
    assert flat.count() == 8 and {r[0] for r in flat.select("ref_aaaamm").distinct().collect()} == set(window)
    write_months(nfe(spark, rows[2]), path)
    assert months_to_flatten(spark, path, window) == ["202602"]
    assert months_to_flatten(spark, path, []) == []


def test_months_with_different_columns_keep_them_all(spark, tmp_path):
    path = str(tmp_path / "table")
    whole = nfe(spark, {**sized(2, 1, 1, 0), "itens_xProd": ["x", "y"], "ref_aaaamm": "202602"})
    write_months(nfe(spark, {**sized(3, 1, 1, 0, "J"), "ref_aaaamm": "202601"}).drop("itens_xProd"), path)
    write_months(whole, path)
    assert flatten_tables(spark, [(path, "nfe")], ["202601", "202602"]) is False
    flat = read_months(spark, flat_path(path), None)
    rows = {(r["ref_aaaamm"], r["itens_xProd"]) for r in flat.collect()}
    assert rows == {("202601", None), ("202602", "x"), ("202602", "y")}


def test_files_of_a_month_do_not_grow_with_the_tasks(spark, tmp_path):
    rows = [{**sized(1, 0, 0, 0, key=f"{m}{i}"), "ref_aaaamm": m} for m in ("202601", "202602", "202603") for i in range(8)]
    write_months(nfe(spark, *rows).repartition(12), str(tmp_path / "table"))
    assert len(list((tmp_path / "table").rglob("*.parquet"))) == 3


def test_a_broken_table_is_reported_and_others_go_on(spark, tmp_path):
    good, bad = str(tmp_path / "good"), tmp_path / "bad"
    write_months(nfe(spark, sized(1, 1, 1, 0)), good)
    (bad / "ref_aaaamm=202602").mkdir(parents=True)
    (bad / "ref_aaaamm=202602" / "x.parquet").write_bytes(b"no parquet")
    assert flatten_tables(spark, [(str(bad), "nfe"), (good, "nfe")], ["202602"]) is True
    assert read_months(spark, flat_path(good), None).count() == 1
