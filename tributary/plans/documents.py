"""Document rows to typed rows: one XML parse per document, then plain column expressions.

Input rows carry the provenance columns below and either ``content`` (bytes) or ``text``, and
optionally ``error_type`` / ``error_message`` when the bytes could not be read.

The parsed tree and the columns that filters look at are emitted through ``inline`` on purpose: the
optimizer does not move filters below a generator, so that a filter on kind or month neither repeats
the parse nor drags the expressions behind those columns along, and the wide projection runs only
for the rows that pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .. import fields as X
from ..functions import bound, literal
from ..functions.dates import iso_date, iso_instant, month_key
from ..functions.numbers import decimal_warning, exact_decimal
from ..functions.text import (
    ASCII_BLANKS, clean, clean_parsed, decode_document, is_blank, join_texts, strip_start,
)
from ..functions.xmlpath import every_node, first_node, first_text
from ..schemas import CORRUPT_COLUMN, CTE_SCHEMA, NFE_SCHEMA, document_schema

PROVENANCE = [
    "source", "source_root", "source_file_path", "source_file_type", "source_entry_path",
    "source_file_mtime", "ingested_at",
]

# Root element after prolog, comments and document type; names may carry a prefix.
_MISC = r"(?:\s|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>)*+"
_ROOT = rf"(?s)^{_MISC}<((?:[^\s<>/:]+:)?([^\s<>/:]+))(?=[\s/>])"
_NOT_MARKUP = r"(?s)<!--.*?-->|<\?.*?\?>|<!\[CDATA\[.*?\]\]>"


def parse_xml(text: str) -> str:
    """Parse tree of a document; ``_corrupt`` is set when it is not well formed."""
    return (
        f"from_xml({text}, {literal(document_schema().simpleString())}, "
        f"map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '{CORRUPT_COLUMN}', "
        "'ignoreNamespace', 'true', 'ignoreSurroundingSpaces', 'true'))"
    )


def _closed_at_end(text: str, tag: str) -> str:
    """True when the first closing tag of the root is the end of the text, as it usually is."""
    at = f"instr({text}, concat('</', {tag}, '>'))"
    rest = f"ltrim({literal(ASCII_BLANKS)}, substring({text}, {at} + length({tag}) + 3))"
    return f"coalesce({at} > 0 and {rest} = '', false)"


def _ends_with_root(text: str, tag: str) -> str:
    """True when nothing but comments, instructions and blanks follows the root element.

    ``from_xml`` stops after the root, so this is what tells two documents glued together, or
    one followed by junk, from a well-formed one. Only texts that are not :func:`_closed_at_end`
    are looked at by pattern.
    """
    bare = f"regexp_replace({text}, {literal(_NOT_MARKUP)}, '')"
    name = f"{literal(chr(92) + 'Q')}, {tag}, {literal(chr(92) + 'E')}"
    closed_once = (
        f"concat({literal('(?s)^(?:(?!</')}, {name}, {literal(r'\s*>).)*+</')}, {name}, "
        f"{literal(r'\s*>\s*$')})"
    )
    self_closed = (
        f"concat({literal(rf'(?s)^{_MISC}<')}, {name}, {literal(r'(?:\s[^<>]*)?/>\s*$')})"
    )
    return f"coalesce({bare} rlike {closed_once} or {bare} rlike {self_closed}, false)"


_TAG_REST = r"""(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*>"""


def without_sections(text: str) -> str:
    """The text without comments and instructions, and with CDATA sections as escaped text.

    What stands inside a section is no markup, so it must not be taken for an element; its text stays.
    """
    kept = f"regexp_replace({text}, {literal(r'(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->|<\?.*?\?>')}, '$1')"
    parts = f"split({kept}, {literal(r'<!\[CDATA\[')})"
    inside = "substring_index(part, ']]>', 1)"
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        inside = f"replace({inside}, '{char}', '{entity}')"
    after = "substring(part, instr(part, ']]>') + 3)"
    joined = f"array_join(transform({parts}, (part, at) -> if(at = 0, part, concat({inside}, {after}))), '')"
    plain = f"not contains({text}, '<!') and not contains({text}, '<?')"
    return f"case when {plain} then {text} when contains({text}, '<![CDATA[') then {joined} else {kept} end"


def element_at_depth(text: str, name: str) -> str:
    """The first element with a local name, at whatever depth, up to its own closing tag; '' if there is none.

    ``text`` has no sections left. From the first opening tag on, tags with the name are counted up and
    down; the element ends where the count is back at zero. Usually that is at the first closing tag like
    the opening one, with no other tag of the name before it.
    """
    opening = literal(rf"<(?:[^\s<>/:]+:)?{name}{_TAG_REST}")
    tag = literal(rf"</?(?:[^\s<>/:]+:)?{name}{_TAG_REST}")
    step = "case when startswith(tag, '</') then -1 when endswith(tag, '/>') then 0 else 1 end"

    def up_to_end(tags: str, between: str) -> str:
        count = (
            f"aggregate({tags}, named_struct('depth', 0, 'n', 0, 'ended', false), (s, tag) -> if(s.ended, s, "
            f"named_struct('depth', s.depth + {step}, 'n', s.n + 1, 'ended', s.depth + {step} = 0)), s -> s.n)"
        )
        return f"array_join(transform(slice({tags}, 1, {count}), (tag, at) -> concat(get({between}, at), tag)), '')"

    def counted(rest: str) -> str:
        tags, between = f"regexp_extract_all({rest}, {tag}, 0)", f"split({rest}, {tag})"
        return bound(tags, lambda t: bound(between, lambda b: up_to_end(t, b), "between"), "tags")

    def element(rest: str) -> str:
        closing = f"concat('</', regexp_extract({rest}, {literal(r'^<([^\s/>]+)')}, 1), '>')"

        def usual(end: str) -> str:
            up_to = f"if(instr({rest}, {end}) = 0, '', substring({rest}, 1, instr({rest}, {end}) + length({end}) - 1))"
            return bound(up_to, lambda u: bound(f"regexp_extract_all({u}, {tag}, 0)", lambda t: either(u, t), "pair"), "upto")

        def either(up_to: str, pair: str) -> str:
            opened = f"startswith({up_to}, get({pair}, 0)) and not endswith(get({pair}, 0), '/>')"
            return f"if(size({pair}) = 2 and {opened} and startswith(get({pair}, 1), '</'), {up_to}, {counted(rest)})"

        return bound(closing, usual, "closing")

    def found(at: str) -> str:
        return f"if({at} = 0, '', {bound(f'substring({text}, {at})', element, 'rest')})"

    return f"if(not contains({text}, '{name}'), '', {bound(f'regexp_instr({text}, {opening})', found, 'found')})"


def _lifted(text: str, wrapper: str, body: str, protocol: str) -> str:
    """Small document made of the first body and first protocol element found at any depth."""

    def made(bare: str) -> str:
        return f"concat('<{wrapper}>', {element_at_depth(bare, body)}, {element_at_depth(bare, protocol)}, '</{wrapper}>')"

    return bound(without_sections(text), made, "bare")


def _sql(df: DataFrame, keep: list[str], **columns: str) -> DataFrame:
    return df.select(*keep, *[F.expr(e).alias(n) for n, e in columns.items()])


def _generated(df: DataFrame, keep: list[str], **columns: str) -> DataFrame:
    """Like a projection, but behind a generator (see the module text)."""
    fields = ", ".join(f"'{n}', {e}" for n, e in columns.items())
    return df.select(*keep, F.expr(f"inline(array(named_struct({fields})))"))


def parse_documents(documents: DataFrame) -> DataFrame:
    """Classifies and parses each document once.

    Result: the provenance columns (and ``fingerprint`` if given) plus

    * ``kind``: ``nfe`` or ``cte`` by root element, NULL when there is none;
    * ``outcome``: ``parsed``, ``no_body``, ``empty`` or ``corrupt``;
    * ``error_type``, ``error_message`` of corrupt documents;
    * ``nfe_body``, ``nfe_protocol``, ``cte_body``, ``cte_protocol``: first matching nodes;
    * ``dhEmi`` (UTC wall time), ``date_fallback``, ``ano_emissao``, ``mes_emissao``,
      ``ref_aaaamm`` (all three from the local time of the document).
    """
    given = documents.columns
    keep = PROVENANCE + [c for c in ("fingerprint",) if c in given]
    read_error = {
        c: f"cast({c if c in given else 'null'} as string)" for c in ("error_type", "error_message")
    }
    if "text" in given:
        blank = f"ltrim({literal(ASCII_BLANKS)}, text) = ''"
        decoded = _sql(documents, keep, text=strip_start("text"), blank=blank, **read_error)
    else:
        decoded = _sql(
            documents, keep, text=decode_document("content"), blank=is_blank("content"), **read_error
        )

    errors = ["error_type", "error_message"]
    rooted = _sql(
        decoded, [*keep, *errors, "text", "blank"],
        tag=f"nullif(regexp_extract(text, {literal(_ROOT)}, 1), '')",
        root=f"nullif(regexp_extract(text, {literal(_ROOT)}, 2), '')",
    )
    roots = ", ".join(literal(r) for r in X.CTE_ROOTS)
    closed = _sql(
        rooted, [*keep, *errors, "text", "blank", "tag", "root"],
        closed=_closed_at_end("text", "tag"),
        is_cte=f"coalesce(root in ({roots}), false)",
    )
    # Beside the tree no part of it becomes a column: each wide struct makes the code of a step so
    # large that the JVM no longer compiles it.
    parsed = _generated(
        closed, [*keep, *errors, "text", "blank", "tag", "root", "closed", "is_cte"], tree=parse_xml("text")
    )

    # Spark computes expressions that occur twice ahead of their conditions, so the pattern gets no text then.
    whole = f"(tree is not null and tree.{CORRUPT_COLUMN} is null and (closed or {_ends_with_root('if(closed, null, text)', 'tag')}))"
    nfe_top = f"if(root = 'NFe', {first_node('tree', 'infNFe')}, {first_node('tree', 'NFe/infNFe')})"
    cte_top = f"if(root = 'CTe', {first_node('tree', 'infCte')}, {first_node('tree', 'CTe/infCte')})"

    def deeper(top: str, wrapper: str, body: str, protocol: str) -> str:
        return (
            f"(({top} is null and root <> '{body}' and contains(text, '{body}')) or "
            f"({first_node('tree', protocol)} is null and contains(text, '{protocol}')))"
        )

    # Only when a body or protocol exists below the first level is a second, small parse made.
    lifted = (
        f"case when not is_cte and {deeper(nfe_top, 'nfeProc', 'NFe', 'protNFe')} and {whole} "
        f"then {_lifted('text', 'nfeProc', 'NFe', 'protNFe')} "
        f"when is_cte and {deeper(cte_top, 'cteProc', 'CTe', 'protCTe')} and {whole} "
        f"then {_lifted('text', 'cteProc', 'CTe', 'protCTe')} end"
    )
    second = _sql(
        parsed, [*keep, *errors, "blank", "root", "tree", "is_cte"],
        whole=whole,
        deep=parse_xml(lifted),
        undecodable="text is null",
    )

    nfe = f"coalesce({nfe_top}, {first_node('deep', 'NFe/infNFe')})"
    cte = f"coalesce({cte_top}, {first_node('deep', 'CTe/infCte')})"
    failed = "error_type is not null"
    usable = f"({failed} or blank or not whole) is not true"
    corrupt = f"({failed} or (blank is not true and not whole))"
    outcome = _sql(
        second, keep,
        kind=f"case when {usable} then if(is_cte, 'cte', 'nfe') end",
        outcome=f"case when {corrupt} then 'corrupt' when blank then 'empty' "
        f"when if(is_cte, {cte} is null, {nfe} is null) then 'no_body' else 'parsed' end",
        error_type=f"case when {failed} then error_type when {corrupt} "
        "then if(undecodable, 'UnicodeDecodeError', 'XMLSyntaxError') end",
        error_message=f"case when {failed} then error_message when {corrupt} "
        "then case when undecodable then 'bytes do not match the charset of the document' "
        "when root is null then 'no root element' else 'document is not well formed' end end",
        nfe_body=f"if({usable} and not is_cte, {nfe}, null)",
        nfe_protocol=f"if({usable} and not is_cte, "
        f"coalesce({first_node('tree', 'protNFe')}, {first_node('deep', 'protNFe')}), null)",
        cte_body=f"if({usable} and is_cte, {cte}, null)",
        cte_protocol=f"if({usable} and is_cte, "
        f"coalesce({first_node('tree', 'protCTe')}, {first_node('deep', 'protCTe')}), null)",
    )
    stated_text = (
        f"coalesce({first_text('nfe_body', 'ide/dhEmi')}, {first_text('cte_body', 'ide/dhEmi')})"
    )
    dated = _sql(outcome, outcome.columns, stated=iso_instant(stated_text))
    dated = _sql(
        dated, dated.columns,
        midnight="if(stated is null, "
        f"cast({iso_date(first_text('nfe_body', 'ide/dEmi'))} as timestamp_ntz), null)",
    )
    local = "coalesce(stated.local, midnight)"
    bodies = ["nfe_body", "nfe_protocol", "cte_body", "cte_protocol"]
    decided = {
        "kind": "kind",
        "outcome": "outcome",
        "date_fallback": "midnight is not null",
        "dhEmi": "coalesce(stated.utc, midnight)",
        "ano_emissao": f"cast(year({local}) as smallint)",
        "mes_emissao": f"cast(month({local}) as tinyint)",
        X.MONTH_COLUMN: month_key(local),
    }
    plain = [*keep, "error_type", "error_message", *bodies]
    ready = _sql(dated, plain, **decided)
    return _generated(ready, plain, **{c: c for c in decided})


# --------------------------------------------------------------------------- typed rows


def _of_kind(kind: str) -> str:
    return f"(kind = '{kind}' and outcome in ('parsed', 'no_body'))"


def invoice_rows(parsed: DataFrame) -> DataFrame:
    """The 85-column goods-invoice table from parsed documents of kind ``nfe``."""
    parts = _with_invoice_parts(parsed.filter(_of_kind("nfe")))
    return parts.select(*[F.expr(e).alias(n) for n, e in _invoice_columns().items()])


def freight_rows(parsed: DataFrame) -> DataFrame:
    """The 43-column freight-waybill table from parsed documents of kind ``cte``."""
    parts = _with_freight_parts(parsed.filter(_of_kind("cte")))
    return parts.select(*[F.expr(e).alias(n) for n, e in _freight_columns().items()])


def both_rows(parsed: DataFrame, wanted: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of every document, and its table row in struct ``nfe`` or ``cte``.

    The structs are NULL, and nothing is computed for them, where ``wanted`` does not hold.
    """
    bodies = ("nfe_body", "nfe_protocol", "cte_body", "cte_protocol")
    blanked = parsed.withColumns({c: F.expr(f"if({wanted}, {c}, null)") for c in bodies})
    parts = _with_freight_parts(_with_invoice_parts(blanked))

    def row(kind: str, columns: dict[str, str]) -> str:
        return f"if({wanted} and {_of_kind(kind)}, {_struct(columns)}, null)"

    return _sql(
        parts, keep, nfe=row("nfe", _invoice_columns()), cte=row("cte", _freight_columns())
    )


def _struct(columns: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in columns.items()) + ")"


def _of_type(table: list[X.Field], kind: str) -> list[X.Field]:
    return [f for f in table if f.type == kind]


def _texts(prefix: str, table: list[X.Field]) -> dict[str, str]:
    """Texts of the fields as columns of their own: those nobody asks for are not computed."""
    return {f"{prefix}_text_{f.column}": first_text(f"{prefix}_body", f.path) for f in table}


def _decimals(texts: str, values: str, table: list[X.Field]) -> dict[str, str]:
    return {f"{values}{f.column}": exact_decimal(f"{texts}{f.column}") for f in _of_type(table, "decimal")}


def _warnings(order: list[str], texts: str, values: str) -> str:
    each = [decimal_warning(c, f"{texts}{c}", f"{values}{c}") for c in order]
    return f"array({', '.join(each)})"


def _scalars(prefix: str, table: list[X.Field]) -> dict[str, str]:
    return {
        f.column: f"{prefix}_{'text' if f.type == 'text' else 'value'}_{f.column}" for f in table
    }


def _key_parts(prefix: str, protocol_path: str, attribute_prefix: str) -> dict[str, str]:
    """Access key from the protocol, else from the identifier attribute of the body."""
    stated = first_text(f"{prefix}_protocol", protocol_path)
    identifier = f"nullif(regexp_replace({clean(f'{prefix}_body._Id')}, '^{attribute_prefix}', ''), '')"
    return {
        f"{prefix}_key": f"if({prefix}_body is null, null, coalesce({stated}, {clean(identifier)}))",
        f"{prefix}_key_fallback": f"{stated} is null and {identifier} is not null",
    }


def _with_sql(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({n: F.expr(e) for n, e in columns.items()})


def _with_invoice_parts(documents: DataFrame) -> DataFrame:
    # An item without a product part is NULL in all of its lists.
    def items(kind: str) -> str:
        fields = _of_type(X.NFE_ITEMS, kind)
        raw = _struct({f.column: first_node("det", f.path) for f in fields})
        raw = f"transform(nfe_body.det, det -> if({first_node('det', 'prod')} is null, null, {raw}))"
        item = _struct({f.column: clean_parsed(f"raw.{f.column}") for f in fields})
        return f"coalesce(transform({raw}, raw -> if(raw is null, null, {item})), array())"

    read = _with_sql(
        documents,
        {
            **_texts("nfe", X.NFE_SCALARS),
            "nfe_items": items("text"),
            "nfe_item_numerals": items("decimal"),
            **_key_parts("nfe", "infProt/chNFe", "NFe"),
        },
    )
    item_values = f"if(item is null, null, {_struct(_decimals('item.', '', X.NFE_ITEMS))})"
    return _with_sql(
        read,
        {
            **_decimals("nfe_text_", "nfe_value_", X.NFE_SCALARS),
            "nfe_item_values": f"transform(nfe_item_numerals, item -> {item_values})",
        },
    )


def _invoice_columns() -> dict[str, str]:
    body = "array(nfe_body)"
    instalments = every_node(body, "cobr/dup")
    references = f"transform({every_node(body, 'ide/NFref')}, r -> get(r.refNFe, 0))"
    values = _scalars("nfe", X.NFE_SCALARS)
    for f in X.NFE_ITEMS:
        values[f.column] = f"{'nfe_items' if f.type == 'text' else 'nfe_item_values'}.{f.column}"
    values.update(
        chNFe="nfe_key",
        refNFe=join_texts(references),
        dup_nDup=f"transform({instalments}, d -> {first_text('d', 'nDup')})",
        dup_dVenc=f"transform({instalments}, d -> {iso_date(first_text('d', 'dVenc'))})",
        pag_tPag=f"transform({every_node(body, 'pag/detPag')}, p -> {first_text('p', 'tPag')})",
    )
    date_warning = (
        f"case when date_fallback then {literal(X.WARN_NFE_DATE_FALLBACK)} "
        f"when dhEmi is null then {literal(X.WARN_NFE_NO_DATE)} end"
    )
    key_warning = (
        f"case when nfe_key_fallback then {literal(X.WARN_NFE_KEY_FALLBACK)} "
        f"when nfe_key is null then {literal(X.WARN_NFE_NO_KEY)} end"
    )
    per_item = (
        "flatten(zip_with(nfe_item_numerals, nfe_item_values, (item, value) -> "
        f"{_warnings(X.NFE_ITEM_WARNING_ORDER, 'item.', 'value.')}))"
    )
    scalar = _warnings(X.NFE_SCALAR_WARNING_ORDER, "nfe_text_", "nfe_value_")
    return _in_order(NFE_SCHEMA, values, [f"array({date_warning}, {key_warning})", scalar, per_item])


def _with_freight_parts(documents: DataFrame) -> DataFrame:
    cargo = f"coalesce({first_node('cte_body', 'infCTeNorm/infCarga')}.infQ, array())"
    linked = f"coalesce({first_node('cte_body', 'infCTeNorm/infDoc')}.infNFe, array())"
    volumes = every_node("array(cte_body)", "transp/vol")
    read = _with_sql(
        documents,
        {
            **_texts("cte", X.CTE_SCALARS),
            "cte_cargo": f"transform({cargo}, n -> {first_text('n', 'qCarga')})",
            "cte_linked": f"transform({linked}, n -> {first_text('n', 'chave')})",
            "cte_volumes": f"transform({volumes}, n -> {first_text('n', 'qVol')})",
            **_key_parts("cte", "infProt/chCTe", "CTe"),
        },
    )
    return _with_sql(
        read,
        {
            **_decimals("cte_text_", "cte_value_", X.CTE_SCALARS),
            "cte_cargo_values": f"transform(cte_cargo, t -> {exact_decimal('t')})",
            "cte_volume_values": f"transform(cte_volumes, t -> {exact_decimal('t')})",
        },
    )


def _freight_columns() -> dict[str, str]:
    values = _scalars("cte", X.CTE_SCALARS)
    values.update(
        chCTe="cte_key",
        cStat=first_text("cte_protocol", "infProt/cStat"),
        infQ_qCarga="cte_cargo_values",
        infNFe_chave="cte_linked",
        transp_qVol="cte_volume_values",
    )
    general = (
        f"array(if(dhEmi is null, {literal(X.WARN_CTE_NO_DATE)}, null), "
        f"case when cte_key_fallback then {literal(X.WARN_CTE_KEY_FALLBACK)} "
        f"when cte_key is null then {literal(X.WARN_CTE_NO_KEY)} end)"
    )
    scalar = _warnings(X.CTE_SCALAR_WARNING_ORDER, "cte_text_", "cte_value_")

    def of_list(column: str, texts: str, numbers: str) -> str:
        return f"zip_with({texts}, {numbers}, (t, v) -> {decimal_warning(column, 't', 'v')})"

    lists = [
        of_list("infQ_qCarga", "cte_cargo", "cte_cargo_values"),
        of_list("transp_qVol", "cte_volumes", "cte_volume_values"),
    ]
    return _in_order(CTE_SCHEMA, values, [general, scalar, *lists])


def _in_order(schema: T.StructType, values: dict[str, str], warnings: list[str]) -> dict[str, str]:
    kept = f"filter(concat({', '.join(warnings)}), w -> w is not null)"
    values["parser_warnings"] = f"get(filter(array({kept}), kept -> size(kept) > 0), 0)"
    columns = {}
    for field in schema:
        value = values.get(field.name, field.name)
        if isinstance(field.dataType, T.ArrayType):
            # A document without a body has no lists at all, as opposed to empty ones.
            value = f"if(outcome = 'parsed', {value}, null)"
        columns[field.name] = f"cast({value} as {field.dataType.simpleString()})"
    return columns
