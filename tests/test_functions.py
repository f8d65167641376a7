from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tributary.functions.dates import iso_date, iso_instant, month_key, utc_wall_time
from tributary.functions.numbers import exact_decimal
from tributary.queries.render import escaped, leaf
from tributary.functions.text import clean, join_texts, quoted


def evaluate(spark, values, expression, type_="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {type_}").repartition(2)
    return [r[1] for r in sorted(df.select("i", F.expr(expression).alias("y")).collect())]


def test_clean(spark):
    assert evaluate(spark, [" a ", "  b\t\n", "  ", "", None, "c d"], clean("x")) == [
        "a", "b", None, None, None, "c d",
    ]


def test_join_texts(spark):
    values = [["a", " b ", None, " "], [None], [], None]
    assert evaluate(spark, values, join_texts("x"), "array<string>") == ["a|b", None, None, None]


def test_quoted_matches_repr(spark):
    values = ["abc", "it's", 'say "x"', "both ' and \"", "back\\slash", "line\nbreak"]
    assert evaluate(spark, values, quoted("x")) == [repr(v) for v in values]


@pytest.mark.parametrize("values", [[
    ("12.5", "12.5"), ("-.5", "-0.5"), ("5.", "5"), ("+7", "7"), ("1e3", "1000"), ("10e-13", "1e-12"),
    ("1e-13", None), ("0.123456789012", "0.123456789012"), ("0.1234567890123", None),
    ("1.20000000000000000", "1.2"), ("abc", None), ("1,5", None), ("NaN", None), ("Infinity", None),
    ("99999999999999999999999999", "99999999999999999999999999"), ("999999999999999999999999999", None),
    (None, None),
]])
def test_exact_decimal(spark, values):
    got = evaluate(spark, [v for v, _ in values], exact_decimal("x"))
    assert got == [None if e is None else Decimal(e) for _, e in values]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(min_value=-10**20, max_value=10**20, places=12), min_size=1, max_size=50))
def test_decimals_keep_every_digit(spark, numbers):
    assert evaluate(spark, [format(n, "f") for n in numbers], exact_decimal("x")) == numbers


def test_iso_instant(spark):
    cases = {
        "2026-02-15T10:30:00-03:00": (dt.datetime(2026, 2, 15, 10, 30), dt.datetime(2026, 2, 15, 13, 30)),
        "2026-02-15T10:30:00.9876": (dt.datetime(2026, 2, 15, 10, 30, 0, 987000),) * 2,
        "20260131T2330": (dt.datetime(2026, 1, 31, 23, 30),) * 2,
        "2026-01-31T23:30:00+0530": (dt.datetime(2026, 1, 31, 23, 30), dt.datetime(2026, 1, 31, 18, 0)),
        "2026-03": (dt.datetime(2026, 3, 1),) * 2,
        "2026-01-31T24:00:00": (dt.datetime(2026, 2, 1),) * 2,
        "10:00": None, "2026-02-30T10:00:00": None, "2026-02-15T10:30:00-03:75": None, "soon": None, "": None,
        None: None,
    }
    got = evaluate(spark, list(cases), iso_instant("x"))
    assert [None if g is None else (g["local"], g["utc"]) for g in got] == list(cases.values())


def test_iso_date(spark):
    assert evaluate(spark, ["2026-03-15", "20260315", "2026-03-15T10:00:00Z", "2026-13-01", "x", None], iso_date("x")) == [
        dt.date(2026, 3, 15)] * 3 + [None] * 3


def test_month_key(spark):
    assert evaluate(spark, [dt.datetime(2026, 2, 1), None], month_key("x"), "timestamp_ntz") == ["202602", None]


def test_utc_wall_time_does_not_depend_on_the_session(spark):
    value = spark.sql("select timestamp_millis(1700000000123) as t").select(F.expr(utc_wall_time("t"))).first()[0]
    assert value == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)


def test_rendered_text_survives_parsing(spark):
    values = ["a & b <c>", "plain", "x > y"]
    xml = f"concat('<r>', {leaf('v', 'x')}, '</r>')"
    assert evaluate(spark, values, f"from_xml({xml}, 'v string').v") == values
    assert evaluate(spark, ["&<>"], escaped("x")) == ["&amp;&lt;&gt;"]
