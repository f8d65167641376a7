"""XML text out of columns, to turn rows of any table into documents."""

from __future__ import annotations

from ..functions import literal


def escaped(value: str) -> str:
    """Character data of an element."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = f"replace({value}, '{char}', '{entity}')"
    return value


def leaf(name: str, value: str) -> str:
    """``<name>value</name>``; nothing at all when the value is NULL."""
    return f"coalesce(concat('<{name}>', {escaped(value)}, '</{name}>'), '')"


def node(name: str, *children: str, attributes: str = "") -> str:
    """Element around other elements. ``attributes`` is literal text."""
    opening = literal(f"<{name} {attributes}>" if attributes else f"<{name}>")
    return f"concat({opening}, {', '.join(children) or repr('')}, '</{name}>')"


def with_id(name: str, identifier: str, *children: str) -> str:
    """Element with an ``Id`` attribute taken from a column."""
    return (
        f"concat('<{name} Id=\"', {escaped(identifier)}, '\">', "
        f"{', '.join(children) or repr('')}, '</{name}>')"
    )


def repeated(count: str, body) -> str:
    """``body(i)`` for i = 1..count, one after the other; nothing for 0."""
    return (
        f"array_join(transform(if({count} > 0, sequence(1, cast({count} as int)), "
        f"cast(array() as array<int>)), i -> {body('i')}), '')"
    )


def invoice(identifier: str, body: list[str], protocol_key: str | None = None) -> str:
    """Goods invoice with its wrapper; the protocol is left out where its key is NULL."""
    parts = [node("NFe", with_id("infNFe", identifier, *body))]
    if protocol_key is not None:
        protocol = node("protNFe", node("infProt", leaf("chNFe", protocol_key)))
        parts.append(f"if({protocol_key} is null, '', {protocol})")
    xmlns = 'xmlns="http://www.portalfiscal.inf.br/nfe" versao="4.00"'
    return node("nfeProc", *parts, attributes=xmlns)


def waybill(identifier: str, body: list[str], protocol_key: str, status: str) -> str:
    """Freight waybill with its wrapper and protocol."""
    protocol = node(
        "protCTe", node("infProt", leaf("chCTe", protocol_key), leaf("cStat", status))
    )
    xmlns = 'xmlns="http://www.portalfiscal.inf.br/cte" versao="4.00"'
    return node(
        "cteProc", node("CTe", with_id("infCte", identifier, *body)), protocol, attributes=xmlns
    )
