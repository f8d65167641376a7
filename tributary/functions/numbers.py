"""Exact decimals from text, never through floating point."""

from __future__ import annotations

from .. import fields as X
from . import literal
from .text import quoted

TYPE = "decimal(38,12)"
_FINEST = "decimal(38,37)"


def exact_decimal(text: str) -> str:
    """DECIMAL(38,12) of a numeral; NULL when it is not a number or needs more than 12 decimals.

    The cast alone would round a 13th digit away, so numerals that may be too long are checked:
    plain ones by their length after the point, written-out exponents by digits minus exponent.
    """
    value = f"try_cast({text} as {TYPE})"
    exponential = f"(contains({text}, 'e') or contains({text}, 'E'))"
    short = f"(instr({text}, '.') = 0 or length({text}) - instr({text}, '.') <= 12)"
    digits = f"length(regexp_extract({text}, {literal(chr(92) + r'.(\d*?)0*(?:[eE].*)?$')}, 1))"
    exponent = (
        f"coalesce(try_cast(regexp_extract({text}, {literal(r'[eE]([+-]?\d{1,6})$')}, 1) as int), 0)"
    )
    # Leading digits may hide zeros in front of a negative exponent ("10e-13"): compare in full.
    in_full = f"try_cast({value} as {_FINEST}) = try_cast({text} as {_FINEST})"
    return (
        f"case when {text} is null then null when not {exponential} and {short} then {value} "
        f"when {digits} - {exponent} <= 12 or {in_full} then {value} end"
    )


def decimal_warning(column: str, text: str, value: str) -> str:
    """Message for a numeral that could not be used, NULL otherwise."""
    prefix = literal(f"{X.WARN_DECIMAL_PREFIX}{column}: ")
    return f"if({text} is not null and {value} is null, concat({prefix}, {quoted(text)}), null)"
