"""Tables in versions: merging by bucket, whole versions for readers, flat copies by bucket."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from test_tables import T0, T1, nfe, sized

from tributary.operators.flatten import flatten_invoices
from tributary.plans.flat_tables import flat_path, flatten_changes, flatten_tables, months_to_flatten
from tributary.schemas import NFE_SCHEMA
from tributary.sinks import versions as V
from tributary.sinks.monthly import read_months, write_months

SCHEMA = "key string, stamp int, tie string, source string, ref_aaaamm string, payload string"


def merge(spark, tmp_path, rows, path, mode="merge", **more):
    df = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
    number = random.getrandbits(40)
    new = V.located(df.repartition(3), f"{tmp_path}/new-{number}")
    return V.merge_version(
        spark, path, new, key="key", schema=df.schema, work=f"{tmp_path}/losers-{number}", mode=mode, newest_first=["stamp", "tie"], **more
    )


def stored(spark, path, number=None):
    rows = V.read_version(spark, path, number=number).collect()
    return sorted(((r["source"], r["ref_aaaamm"], r["key"], r["stamp"], r["tie"]) for r in rows), key=str)


def plainly(state, rows, mode):
    """The same by a dictionary; NULL order values are oldest."""
    months = {r[4] for r in rows if r[0] is not None and r[4] is not None}
    if mode == "replace":
        state = {k: r for k, r in state.items() if k[1] not in months}
    for r in rows:
        if r[0] is None or r[4] is None:
            continue
        place = (r[3], r[4], r[0])
        order = tuple((v is not None, v) if v is not None else (False,) for v in r[1:3])
        if place not in state or order > state[place][0]:
            state[place] = (order, r)
    return state


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_equal_a_dictionary(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(V, "ROWS_PER_BUCKET", 6)
    monkeypatch.setattr(V, "BROADCAST_ROWS", 5 if seed == 1 else 1000)
    dice, path, state = random.Random(seed), str(tmp_path / "table"), {}
    for run in range(6):
        mode = "replace" if run == 4 else "merge"
        rows = [
            (dice.choice([None, *map(str, range(40))]), dice.choice([None, run, 9]), dice.choice([None, f"{run}-{i:03d}"]),
             dice.choice("ab"), dice.choice(["202601", "202602", "202603", None] if run else ["202601"]), "p" * 20)
            for i in range(dice.choice([1, 30, 60]))
        ]
        # Ties in all order columns may keep either row: give every row another one.
        rows = [(k, s, f"{t or ''}{run}{i}", *rest) for i, (k, s, t, *rest) in enumerate(rows)]
        state = plainly(state, rows, mode)
        merge(spark, tmp_path, rows, path, mode)
        assert stored(spark, path) == sorted(((r[3], r[4], r[0], r[1], r[2]) for _, r in state.values()), key=str)
    counts = V.manifest(spark, path).groupBy("part").agg(F.sum("rows").alias("n"), F.max("buckets").alias("b")).collect()
    assert sum(r["n"] for r in counts) == len(state) and max(r["b"] for r in counts) > 1


def test_one_new_document_rewrites_its_bucket_and_nothing_else(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "ROWS_PER_BUCKET", 10)
    path = str(tmp_path / "table")
    rows = [(f"k{i}", 1, f"{i}", "s", m, "x") for i in range(100) for m in ("202601", "202602")]
    merge(spark, tmp_path, rows, path)
    before = {(r["part"], r["bucket"]): r["version"] for r in V.entries_of(spark, path)}
    merge(spark, tmp_path, [("k7", 2, "new", "s", "202602", "y")], path)
    after = {(r["part"], r["bucket"]): r["version"] for r in V.entries_of(spark, path)}
    changed = [k for k in after if after[k] != before.get(k)]
    assert len(before) > 10 and len(changed) == 1 and changed[0][0] == "202602" and set(after) == set(before)
    assert sum(r["rows"] for r in V.entries_of(spark, path)) == 200
    assert [r for r in stored(spark, path) if r[3] == 2] == [("s", "202602", "k7", 2, "new")]


def test_wide_rows_go_through_one_exchange(spark, tmp_path, monkeypatch):
    plans = []
    write = V.write_buckets

    def watched(rows, path, label, sort_by, column):
        shuffled = rows.hint("rebalance", "ref_aaaamm", V.BUCKET)
        plans.append(shuffled._jdf.queryExecution().executedPlan().toString())
        return write(rows, path, label, sort_by, column)

    monkeypatch.setattr(V, "write_buckets", watched)
    path = str(tmp_path / "table")
    for stamp in (1, 2):
        merge(spark, tmp_path, [(f"k{i % 20}", stamp, f"{i}", "s", "202601", "wide") for i in range(30)], path)
    for plan in plans:
        wide = [line for line in plan.splitlines() if re.search(r"(?<!Broadcast)Exchange", line)]
        assert len(wide) == 1 and "REBALANCE" in wide[0]
        assert "Window" not in plan and "BroadcastHashJoin" in plan


def test_a_key_with_a_third_of_all_rows(spark, tmp_path):
    rows = [("hot" if i % 3 == 0 else f"k{i}", i, f"{i}", "s", "202601", "x") for i in range(3000)]
    merge(spark, tmp_path, rows, str(tmp_path / "table"))
    left = stored(spark, str(tmp_path / "table"))
    assert len(left) == 2001 and ("s", "202601", "hot", 2997, "2997") in left


def test_readers_see_whole_versions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    one = [(f"k{i}", 1, f"{i}", "s", "202601", "x") for i in range(20)]
    merge(spark, tmp_path, one, path)
    opened = V.read_version(spark, path)
    merge(spark, tmp_path, [(f"k{i}", 2, f"{i}", "s", "202601", "x") for i in range(10, 30)], path)
    assert {r["stamp"] for r in opened.collect()} == {1} and opened.count() == 20
    assert len(stored(spark, path)) == 30 and len(stored(spark, path, 1)) == 20

    def breaks(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(V, "commit", breaks)
        with pytest.raises(KeyboardInterrupt):
            merge(spark, tmp_path, [("k1", 3, "z", "s", "202601", "x")], path)
    assert {r[3] for r in stored(spark, path)} == {1, 2} and V.current_version(spark, path) == 2
    # A manifest without its mark does not count.
    (tmp_path / "table/_manifest/000000000003").mkdir()
    assert V.current_version(spark, path) == 2


def test_a_second_writer_of_the_same_version_fails(spark, tmp_path):
    path = str(tmp_path / "table")
    merge(spark, tmp_path, [("a", 1, "1", "s", "202601", "x")], path)
    V.commit(spark, path, 1, V.manifest(spark, path))
    with pytest.raises(AnalysisException):
        V.commit(spark, path, 1, V.manifest(spark, path))


def test_old_versions_go_and_shared_buckets_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "ROWS_PER_BUCKET", 10)
    path = str(tmp_path / "table")
    merge(spark, tmp_path, [(f"k{i}", 1, f"{i}", "s", "202601", "x") for i in range(100)], path)
    for stamp in range(2, 7):
        merge(spark, tmp_path, [("k5", stamp, "t", "s", "202601", "x")], path)
    assert len(stored(spark, path)) == 100 and V.current_version(spark, path) == 6
    assert sorted(p.name for p in (tmp_path / "table/_manifest").iterdir() if p.is_dir()) == ["000000000005", "000000000006"]
    # The first write still holds what was never replaced; of the others two are left.
    assert len(list((tmp_path / "table/_data").iterdir())) == 3


def test_plain_months_become_part_of_the_first_version(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [{**sized(1, 0, 0, 0, key=f"{m}-{i}"), "ref_aaaamm": m, "ingested_at": T0} for m in ("202601", "202602") for i in range(3)]
    write_months(nfe(spark, *rows), path, sort_by="chNFe")
    new = V.located(nfe(spark, {**rows[0], "nNF": "new", "ingested_at": T1}), str(tmp_path / "new"))
    V.merge_version(spark, path, new, key="chNFe", schema=NFE_SCHEMA, work=str(tmp_path / "losers"))
    found = read_months(spark, path, NFE_SCHEMA).collect()
    assert len(found) == 6 and {r.chNFe: r.nNF for r in found}["202601-0"] == "new"
    assert {e["part"]: e["version"] == V.PLAIN for e in V.entries_of(spark, path)} == {"202601": False, "202602": True}
    assert read_months(spark, path, None, ["202602"]).count() == 3 and not (tmp_path / "table/ref_aaaamm=202603").exists()
    assert [f.name for f in read_months(spark, path, NFE_SCHEMA).schema] == NFE_SCHEMA.fieldNames()


def test_rows_without_key_or_month_and_empty_input(spark, tmp_path):
    path = str(tmp_path / "table")
    assert merge(spark, tmp_path, [(None, 1, "1", "s", "202601", "x"), ("a", 1, "1", "s", None, "x")], path) == 0
    assert merge(spark, tmp_path, spark.createDataFrame([], SCHEMA), path) == 0 and V.current_version(spark, path) == 0
    assert V.read_version(spark, path) is None


def test_flat_copy_follows_by_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "ROWS_PER_BUCKET", 4)
    path, window = str(tmp_path / "table"), ["202601", "202602"]

    def add(*rows, mode="merge"):
        new = V.located(nfe(spark, *rows), f"{tmp_path}/new-{random.getrandbits(40)}")
        V.merge_version(spark, path, new, key="chNFe", schema=NFE_SCHEMA, work=f"{tmp_path}/losers", mode=mode)

    def flat_equals_source():
        flat = read_months(spark, flat_path(path), None)
        expected = flatten_invoices(read_months(spark, path, NFE_SCHEMA))
        names = ["chNFe", "item_seq", "itens_cProd", "dup_nDup", "ref_aaaamm"]
        return sorted(map(str, flat.select(names).collect())) == sorted(map(str, expected.select(names).collect()))

    assert flatten_changes(spark, path, "nfe", window) == 0
    rows = [{**sized(2, 2, 1, 0, key=f"k{i}"), "ref_aaaamm": m, "ingested_at": T0} for m in window for i in range(20)]
    add(*rows)
    assert months_to_flatten(spark, path, window) == window
    assert flatten_tables(spark, [(path, "nfe")], window) is False and flat_equals_source()
    assert months_to_flatten(spark, path, window) == []
    before = {(e["part"], e["bucket"]): e["version"] for e in V.entries_of(spark, flat_path(path))}
    add({**rows[0], **sized(5, 1, 1, 0, key="k0"), "ref_aaaamm": "202601", "ingested_at": T1})
    assert months_to_flatten(spark, path, window) == ["202601"]
    assert flatten_changes(spark, path, "nfe", window) == 1 and flat_equals_source()
    after = {(e["part"], e["bucket"]): e["version"] for e in V.entries_of(spark, flat_path(path))}
    assert sum(after[k] != before[k] for k in after) == 1
    # A replaced month has fewer buckets; the flat ones without a source go.
    add({**sized(1, 1, 1, 0, key="only"), "ref_aaaamm": "202602"}, mode="replace")
    flatten_changes(spark, path, "nfe", window)
    assert flat_equals_source() and flatten_changes(spark, path, "nfe", window) == 0


def test_positions_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Files of positions are small for their number: going by bytes, Spark sent millions through the driver."""
    rows = [(f"k{i % 20}", i, f"{i}", "s", "202601", "wide") for i in range(60)]
    new = V.located(spark.createDataFrame(rows, SCHEMA).repartition(3), f"{tmp_path}/new")
    losing = V.losing_positions(new, "key", ["source", "ref_aaaamm"], ["stamp", "tie"])
    plan = losing._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and losing.count() == 40

    plans = []
    write = V.write_buckets

    def watched(rows, path, label, sort_by, column):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(rows, path, label, sort_by, column)

    monkeypatch.setattr(V, "write_buckets", watched)
    monkeypatch.setattr(V, "BROADCAST_ROWS", 10)
    merge(spark, tmp_path, rows, str(tmp_path / "table"))
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
    assert len(stored(spark, str(tmp_path / "table"))) == 20
