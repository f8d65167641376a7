"""Expressions as SQL text: XML paths, text clean-up, exact numbers, ISO dates, byte decoding.

Each function takes and returns SQL text, to be used with ``F.expr`` or inside ``spark.sql``. A
document row has about 130 derived columns; as text each of them reaches Spark in one call.
"""

from __future__ import annotations


def literal(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bound(value: str, body, name: str = "v") -> str:
    """``body`` of a name that stands for ``value``, which is then computed only once."""
    return f"get(transform(array({value}), {name} -> {body(name)}), 0)"
