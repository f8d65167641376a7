"""Parsing: table rows are rendered as XML documents and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import literal
from .render import invoice, leaf, node, repeated, waybill, with_id
from ..operators.flatten import flatten_freight, flatten_invoices
from ..operators.rules import within_rules
from ..plans.ingest import DOCUMENTS_PER_TASK
from ..plans.documents import freight_rows, invoice_rows, parse_documents
from ..plans.work import spread
from . import query, table

NOW = "1998-01-15"
ORDER_KEY = "lpad(cast(o_orderkey as string), 44, '0')"
MONEY = "cast(cast(o_totalprice as decimal(18,2)) as string)"
DAY = "date_format(o_orderdate, 'yyyy-MM-dd')"


def rendered(rows: DataFrame, path: str, text: str, source: str = "'orders'") -> DataFrame:
    """Document rows with the provenance columns, one per row of a table."""
    columns = {
        "source": source,
        "source_root": "'tables'",
        "source_file_path": path,
        "source_file_type": "'xml'",
        "source_entry_path": "cast(null as string)",
        "source_file_mtime": "timestamp_ntz'2001-01-01 00:00:00'",
        "ingested_at": "timestamp_ntz'2001-01-02 00:00:00'",
        "text": text,
    }
    spread_rows = spread(rows, DOCUMENTS_PER_TASK)
    return spread_rows.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def order_items(count: str) -> str:
    """``count`` items per order, derived from the order itself; every fifth has no product."""
    product = node(
        "prod",
        leaf("cProd", "concat('P', cast(o_custkey + i as string))"),
        leaf("xProd", "concat(' item <', cast(i as string), '> & more ')"),
        leaf("CFOP", "'5102'"),
        leaf("uCom", "if(i % 2 = 0, 'KG', 'UN')"),
        leaf("qCom", "cast(cast(i as decimal(18,4)) as string)"),
        leaf("vUnCom", MONEY),
        leaf("vProd", f"if(i % 3 = 0, null, {MONEY})"),
    )
    tax = node(
        "imposto",
        node("IBSCBS", leaf("CST", "'000'"), leaf("cClassTrib", "cast(o_custkey as string)")),
        node("PIS", node("PISQtde", leaf("CST", "'03'"), leaf("vPIS", "cast(i as string)"))),
        node("ICMS", node("ICMS15", leaf("orig", "'0'"), leaf("adRemICMS", "'0.1250'"))),
    )
    item = f"if((o_orderkey + i) % 5 = 0, {node('det', tax)}, {node('det', product, tax)})"
    return repeated(count, lambda i: item)


def order_text(*parts: str, protocol_key: str = ORDER_KEY, identifier: str | None = None) -> str:
    return invoice(identifier or f"concat('NFe', {ORDER_KEY})", list(parts), protocol_key)


ITEMS_PER_ORDER = "o_orderkey % 4"


def full_order_text() -> str:
    """Order as a complete invoice: header, parties, items, totals, instalments, payments."""
    return order_text(
        node(
            "ide",
            leaf("natOp", "concat('  ', o_orderpriority, '  ')"),
            leaf("natOp", "'second one is ignored'"),
            leaf("mod", "'55'"),
            leaf("nNF", "cast(o_orderkey as string)"),
            leaf("dhEmi", f"concat({DAY}, 'T10:30:00-03:00')"),
        ),
        node(
            "emit",
            leaf("CNPJ", "lpad(cast(o_custkey as string), 14, '0')"),
            leaf("xNome", "'Seller & Sons'"),
            node("enderEmit", leaf("UF", "o_orderstatus"), leaf("xMun", "'   '")),
        ),
        node("dest", leaf("CPF", "'1'"), leaf("xNome", "concat('Customer ', cast(o_custkey as string))")),
        order_items(ITEMS_PER_ORDER),
        node("total", node("ICMSTot", leaf("vBC", MONEY), leaf("vICMS", "'0.00'")), leaf("vNFTot", MONEY)),
        node(
            "cobr",
            repeated(
                "o_custkey % 3",
                lambda i: node(
                    "dup",
                    leaf("nDup", f"lpad(cast({i} as string), 3, '0')"),
                    leaf("dVenc", f"date_format(date_add(cast(o_orderdate as date), {i}), 'yyyy-MM-dd')"),
                ),
            ),
        ),
        node("pag", repeated("o_orderkey % 2", lambda i: node("detPag", leaf("tPag", "'15'")))),
    )


def orders_parsed(spark: SparkSession, sf: str, text: str) -> DataFrame:
    return parse_documents(rendered(table(spark, sf, "orders"), f"concat('order-', cast(o_orderkey as string))", text))


@query(
    """
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS "chNFe", CAST(o_orderkey AS VARCHAR) AS "nNF",
      o_orderpriority AS "natOp", '55' AS "mod",
      o_orderdate + INTERVAL 13 HOUR + INTERVAL 30 MINUTE AS "dhEmi",
      lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS "emit_CNPJ", 'Seller & Sons' AS "emit_xNome",
      o_orderstatus AS "emit_UF", CAST(NULL AS VARCHAR) AS "emit_xMun", CAST(NULL AS VARCHAR) AS "dest_CNPJ",
      'Customer ' || CAST(o_custkey AS VARCHAR) AS "dest_xNome",
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,12)) AS "vBC",
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,12)) AS "vNFTot",
      CAST(year(o_orderdate) AS SMALLINT) AS ano_emissao, CAST(month(o_orderdate) AS TINYINT) AS mes_emissao,
      strftime(o_orderdate, '%Y%m') AS ref_aaaamm, CAST(NULL AS VARCHAR) AS warnings
    FROM orders
    """
)
def parse_header(spark, sf):
    rows = invoice_rows(orders_parsed(spark, sf, full_order_text()))
    return rows.select(
        "chNFe", "nNF", "natOp", "mod", "dhEmi", "emit_CNPJ", "emit_xNome", "emit_UF", "emit_xMun",
        "dest_CNPJ", "dest_xNome", "vBC", "vNFTot", "ano_emissao", "mes_emissao", "ref_aaaamm",
        F.array_join("parser_warnings", "; ").alias("warnings"),
    )


_ORDER_ITEMS_SQL = """
    items AS (
      SELECT o_orderkey, CAST(i AS SMALLINT) AS item_seq,
        (o_orderkey + i) % 5 <> 0 AS has_product, i, o_custkey,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,12)) AS money
      FROM orders, LATERAL (SELECT unnest(generate_series(1, o_orderkey % 4)) AS i)
    ),
    flat_items AS (
      SELECT o_orderkey, item_seq,
        CASE WHEN has_product THEN 'P' || CAST(o_custkey + i AS VARCHAR) END AS "itens_cProd",
        CASE WHEN has_product THEN 'item <' || CAST(i AS VARCHAR) || '> & more' END AS "itens_xProd",
        CASE WHEN has_product THEN '5102' END AS "itens_CFOP",
        CASE WHEN has_product THEN CASE WHEN i % 2 = 0 THEN 'KG' ELSE 'UN' END END AS "itens_uCom",
        CASE WHEN has_product THEN CAST(i AS DECIMAL(38,12)) END AS "itens_qCom",
        CASE WHEN has_product THEN money END AS "itens_vUnCom",
        CASE WHEN has_product AND i % 3 <> 0 THEN money END AS "itens_vProd",
        CASE WHEN has_product THEN '000' END AS "itens_IBSCBS_CST",
        CASE WHEN has_product THEN CAST(o_custkey AS VARCHAR) END AS "itens_IBSCBS_cClassTrib",
        CASE WHEN has_product THEN '03' END AS "itens_PIS_CST",
        CASE WHEN has_product THEN CAST(i AS DECIMAL(38,12)) END AS "itens_PIS_vPIS",
        CASE WHEN has_product THEN CAST(0.125 AS DECIMAL(38,12)) END AS "itens_ICMS15_adRemICMS"
      FROM items
    )
"""
_ITEM_COLUMNS = [
    "itens_cProd", "itens_xProd", "itens_CFOP", "itens_uCom", "itens_qCom", "itens_vUnCom", "itens_vProd",
    "itens_IBSCBS_CST", "itens_IBSCBS_cClassTrib", "itens_PIS_CST", "itens_PIS_vPIS", "itens_ICMS15_adRemICMS",
]
_QUOTED_ITEMS = ", ".join(f'"{c}"' for c in _ITEM_COLUMNS)


@query(
    f"""
    WITH {_ORDER_ITEMS_SQL},
    dups AS (
      SELECT o_orderkey, lpad(CAST(i AS VARCHAR), 3, '0') AS "dup_nDup",
        CAST(o_orderdate AS DATE) + CAST(i AS INTEGER) AS "dup_dVenc"
      FROM orders, LATERAL (SELECT unnest(generate_series(1, o_custkey % 3)) AS i)
    )
    SELECT lpad(CAST(o.o_orderkey AS VARCHAR), 44, '0') AS "chNFe", item_seq, {_QUOTED_ITEMS},
      "dup_nDup", "dup_dVenc", CASE WHEN o.o_orderkey % 2 = 1 THEN '15' END AS "pag_tPag",
      strftime(o_orderdate, '%Y%m') AS ref_aaaamm
    FROM orders o LEFT JOIN flat_items f ON f.o_orderkey = o.o_orderkey
      LEFT JOIN dups d ON d.o_orderkey = o.o_orderkey
    """
)
def parse_items(spark, sf):
    """Whole invoices parsed and unnested: items x instalments x payments x warnings."""
    flat = flatten_invoices(invoice_rows(orders_parsed(spark, sf, full_order_text())))
    return flat.select(
        "chNFe", "item_seq", *_ITEM_COLUMNS, "dup_nDup", "dup_dVenc", "pag_tPag", "ref_aaaamm"
    )


@query(
    """
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS "chNFe",
      o_orderdate + INTERVAL 26 HOUR + INTERVAL 30 MINUTE AS "dhEmi",
      strftime(o_orderdate, '%Y%m') AS ref_aaaamm,
      CAST(year(o_orderdate) AS SMALLINT) AS ano_emissao, CAST(month(o_orderdate) AS TINYINT) AS mes_emissao
    FROM orders
    """
)
def issue_month_offset(spark, sf):
    """Late evening at an offset: the month is the document's own, the instant is in UTC."""
    text = order_text(node("ide", leaf("dhEmi", f"concat({DAY}, 'T23:30:00-03:00')")))
    return invoice_rows(orders_parsed(spark, sf, text)).select(
        "chNFe", "dhEmi", "ref_aaaamm", "ano_emissao", "mes_emissao"
    )


@query(
    """
    SELECT o_orderkey,
      CASE o_orderkey % 8
        WHEN 0 THEN o_orderdate + INTERVAL 10 HOUR
        WHEN 1 THEN o_orderdate + INTERVAL 10 HOUR + INTERVAL 5 MINUTE + INTERVAL 7123 MILLISECOND
        WHEN 2 THEN o_orderdate + INTERVAL 15 HOUR + INTERVAL 35 MINUTE
        WHEN 3 THEN date_trunc('month', o_orderdate)
        WHEN 4 THEN o_orderdate + INTERVAL 1 DAY
        WHEN 5 THEN o_orderdate + INTERVAL 10 HOUR END AS utc,
      CASE WHEN o_orderkey % 8 = 4 THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m')
           WHEN o_orderkey % 8 < 6 THEN strftime(o_orderdate, '%Y%m') END AS month
    FROM orders
    """
)
def issue_time_shapes(spark, sf):
    """Accepted spellings of ISO-8601 times, and texts that are none."""
    from ..functions.dates import iso_instant, month_key

    compact = "date_format(o_orderdate, 'yyyyMMdd')"
    text = f"""case o_orderkey % 8
        when 0 then concat({DAY}, 'T10:00:00')
        when 1 then concat({DAY}, 'T10:05:07.123987')
        when 2 then concat({compact}, 'T103500-0500')
        when 3 then date_format(o_orderdate, 'yyyy-MM')
        when 4 then concat({DAY}, 'T24:00:00Z')
        when 5 then concat({DAY}, ' 13+03')
        when 6 then '10:00' else concat({DAY}, 'T25:00:00') end"""
    stamped = table(spark, sf, "orders").select("o_orderkey", F.expr(iso_instant(text)).alias("at"))
    return stamped.select(
        "o_orderkey", F.col("at.utc").alias("utc"), F.expr(month_key("at.local")).alias("month")
    )


@query(
    """
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS "chNFe",
      CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate
           WHEN o_orderkey % 7 = 0 THEN NULL
           ELSE o_orderdate + INTERVAL 12 HOUR END AS "dhEmi",
      CASE WHEN o_orderkey % 3 = 0 THEN 'dhEmi ausente/ inválido; usado dEmi como fallback'
           WHEN o_orderkey % 7 = 0 THEN 'sem dhEmi/dEmi parseável' END AS warnings
    FROM orders
    """
)
def issue_date_fallback(spark, sf):
    text = order_text(
        node(
            "ide",
            leaf(
                "dhEmi",
                f"case when o_orderkey % 7 = 0 then 'not a date' when o_orderkey % 3 = 0 then null "
                f"else concat({DAY}, 'T12:00:00Z') end",
            ),
            leaf("dEmi", f"if(o_orderkey % 3 = 0, {DAY}, null)"),
        )
    )
    return invoice_rows(orders_parsed(spark, sf, text)).select(
        "chNFe", "dhEmi", F.array_join("parser_warnings", " / ").alias("warnings")
    )


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS "nNF",
      CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE lpad(CAST(o_orderkey AS VARCHAR), 44, '0') END AS "chNFe",
      CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 3 THEN 'chNFe ausente'
        ELSE 'chNFe via fallback infNFe/@Id' END AS warnings
    FROM orders
    """
)
def access_key_fallback(spark, sf):
    """Key from the protocol, else from the identifier with or without its prefix, else none."""
    text = order_text(
        node("ide", leaf("nNF", "cast(o_orderkey as string)"), leaf("dhEmi", f"concat({DAY}, 'T12:00:00Z')")),
        protocol_key=f"case o_orderkey % 4 when 0 then {ORDER_KEY} when 1 then null when 2 then '  ' end",
        identifier=f"case o_orderkey % 4 when 1 then concat('NFe', {ORDER_KEY}) "
        f"when 2 then concat(' ', {ORDER_KEY}) when 3 then ' NFe ' else 'NFe0' end",
    )
    return invoice_rows(orders_parsed(spark, sf, text)).select(
        "nNF", "chNFe", F.array_join("parser_warnings", " / ").alias("warnings")
    )


_NUMERALS = {
    0: ("12.5", "12.5"), 1: ("abc", None), 2: ("1.5e3", "1500"), 3: ("12,50", None),
    4: ("", None), 5: ("0.1234567890123", None), 6: ("1.2000000000000000", "1.2"),
    7: ("-.5", "-0.5"), 8: ("NaN", None), 9: ("it's", None),
}
_NO_WARNING = (0, 2, 4, 6, 7)


def _numeral_case(pick) -> str:
    return "CASE o_orderkey % 10 " + " ".join(f"WHEN {k} THEN {pick(k)}" for k in _NUMERALS) + " END"


def _expected_value(k: int) -> str:
    value = _NUMERALS[k][1]
    return "NULL" if value is None else f"CAST({value} AS DECIMAL(38,12))"


def _expected_warning(k: int, column: str) -> str:
    if k in _NO_WARNING:
        return "NULL"
    shown = repr(_NUMERALS[k][0]).replace("'", "''")
    return f"'decimal inválido em {column}: {shown}'"


@query(
    f"""
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS "chNFe",
      {_numeral_case(_expected_value)} AS "vBC",
      {_numeral_case(_expected_value)} AS "itens_qCom",
      {_numeral_case(lambda k: _expected_warning(k, 'vBC'))} AS first_warning,
      {_numeral_case(lambda k: _expected_warning(k, 'itens_qCom'))} AS second_warning,
      CAST({_numeral_case(lambda k: '0' if k in _NO_WARNING else '2')} AS INTEGER) AS n_warnings
    FROM orders
    """
)
def decimal_warnings(spark, sf):
    numeral = "case o_orderkey % 10 " + " ".join(
        f"when {k} then {literal(v[0])}" for k, v in _NUMERALS.items()
    ) + " end"
    text = order_text(
        node("ide", leaf("dhEmi", f"concat({DAY}, 'T12:00:00Z')")),
        node("det", node("prod", leaf("qCom", numeral))),
        node("total", node("ICMSTot", leaf("vBC", numeral))),
    )
    return invoice_rows(orders_parsed(spark, sf, text)).select(
        "chNFe", "vBC", F.get("itens_qCom", F.lit(0)).alias("itens_qCom"),
        F.get("parser_warnings", F.lit(0)).alias("first_warning"),
        F.get("parser_warnings", F.lit(1)).alias("second_warning"),
        F.coalesce(F.size("parser_warnings"), F.lit(0)).cast("int").alias("n_warnings"),
    )


@query(
    """
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS "chNFe",
      nullif(array_to_string(list_transform(
        list_filter(generate_series(1, o_orderkey % 5), lambda i: i % 3 <> 0),
        lambda i: 'ref' || CAST(o_custkey + i AS VARCHAR)), '|'), '') AS "refNFe"
    FROM orders
    """
)
def ref_join(spark, sf):
    """Referenced keys of all reference groups, joined; blank ones are left out."""
    reference = "if(i % 3 = 0, '  ', concat(' ref', cast(o_custkey + i as string)))"
    text = order_text(
        node(
            "ide",
            leaf("dhEmi", f"concat({DAY}, 'T12:00:00Z')"),
            repeated("o_orderkey % 5", lambda i: node("NFref", leaf("refNFe", reference))),
        )
    )
    return invoice_rows(orders_parsed(spark, sf, text)).select("chNFe", "refNFe")


@query(
    """
    SELECT CASE o_orderkey % 9 WHEN 1 THEN 'cte' WHEN 2 THEN 'cte' WHEN 3 THEN NULL WHEN 4 THEN NULL
        WHEN 8 THEN NULL ELSE 'nfe' END AS kind,
      CASE o_orderkey % 9 WHEN 3 THEN 'corrupt' WHEN 4 THEN 'empty' WHEN 2 THEN 'no_body' WHEN 5 THEN 'no_body'
        WHEN 8 THEN 'corrupt' ELSE 'parsed' END AS outcome,
      count(*) AS n
    FROM orders GROUP BY ALL
    """
)
def classify_documents(spark, sf):
    key = "cast(o_orderkey as string)"
    bare = with_id("p:infNFe", key)
    text = f"""case o_orderkey % 9
        when 0 then concat('<?xml version="1.0" encoding="UTF-8"?><!-- <CTe> -->',
                           {invoice(key, [leaf('x', key)], key)})
        when 1 then {waybill(key, [leaf('x', key)], key, "'100'")}
        when 2 then '<cteProc><CTe><other/></CTe></cteProc>'
        when 3 then concat('<NFe><infNFe Id="', {key}, '">')
        when 4 then '  '
        when 5 then '<envelope/>'
        when 6 then concat(' \n', {node('p:NFe', bare, attributes='xmlns:p="urn:x"')}, ' <!-- end -->')
        when 7 then concat('<env><list>', {node('NFe', with_id('infNFe', key))}, '</list></env>')
        else '<NFe><infNFe/></NFe><NFe/>' end"""
    parsed = orders_parsed(spark, sf, text)
    return parsed.groupBy("kind", "outcome").agg(F.count(F.lit(1)).alias("n"))


def line_waybill() -> tuple[str, str]:
    """Key and text of a freight waybill for a shipped line."""
    price = "cast(cast(l_extendedprice as decimal(18,2)) as string)"
    key = (
        "concat('k', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '-', " + price + ")"
    )
    quantity = "cast(cast(l_quantity as decimal(18,2)) + i as string)"
    text = waybill(
        f"concat('CTe', {key})",
        [
            node(
                "ide",
                leaf("serie", "lpad(cast(l_linenumber as string), 3, '0')"),
                leaf("dhEmi", "date_format(l_shipdate, \"yyyy-MM-dd'T12:00:00Z'\")"),
                node("toma3", leaf("toma", "'3'")),
            ),
            node("vPrest", leaf("vTPrest", price)),
            node("imp", node("ICMS", node("ICMS00", leaf("vICMS", f"if(l_linenumber % 2 = 0, {price}, null)")))),
            node(
                "infCTeNorm",
                node("infCarga", repeated("l_linenumber % 3", lambda i: node("infQ", leaf("qCarga", quantity)))),
                node(
                    "infDoc",
                    repeated(
                        "l_linenumber % 4",
                        lambda i: node("infNFe", leaf("chave", "concat('doc', cast(l_partkey + i as string))")),
                    ),
                ),
            ),
        ],
        key,
        "'100'",
    )
    return key, text


@query(
    """
    WITH q AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s,
        l_quantity AS qty, l_extendedprice AS price, l_shipdate AS d FROM lineitem),
    doc AS (
      SELECT *, 'k' || k || '-' || n || '-' || p || '-' || s || '-' || CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR) AS key
      FROM q
    )
    SELECT key AS "chCTe", lpad(CAST(n AS VARCHAR), 3, '0') AS serie, d + INTERVAL 12 HOUR AS "dhEmi",
      CAST(CAST(price AS DECIMAL(18,2)) AS DECIMAL(38,12)) AS "vTPrest",
      CASE WHEN n % 2 = 0 THEN CAST(CAST(price AS DECIMAL(18,2)) AS DECIMAL(38,12)) END AS "vICMS00",
      '100' AS "cStat", '3' AS toma, strftime(d, '%Y%m') AS ref_aaaamm,
      CASE WHEN n % 3 = 0 THEN NULL ELSE CAST(CAST(qty AS DECIMAL(18,2)) + c AS DECIMAL(38,12)) END AS "infQ_qCarga",
      CASE WHEN n % 4 = 0 THEN NULL ELSE 'doc' || CAST(p + e AS VARCHAR) END AS "infNFe_chave",
      CAST(NULL AS DECIMAL(38,12)) AS "transp_qVol"
    FROM doc, LATERAL (SELECT unnest(generate_series(1, greatest(n % 3, 1))) AS c),
      LATERAL (SELECT unnest(generate_series(1, greatest(n % 4, 1))) AS e)
    """
)
def freight_lists(spark, sf):
    """Each shipped line as a freight waybill, parsed and unnested."""
    key, text = line_waybill()
    parsed = parse_documents(rendered(table(spark, sf, "lineitem"), key, text, "'lines'"))
    return flatten_freight(freight_rows(parsed)).select(
        "chCTe", "serie", "dhEmi", "vTPrest", "vICMS00", "cStat", "toma", "ref_aaaamm",
        "infQ_qCarga", "infNFe_chave", "transp_qVol",
    )


@query(
    """
    SELECT o_orderkey, o_custkey, array_to_string(list_filter(
        [trim(o_orderpriority), nullif(trim(o_orderstatus), ''), 'x'], lambda t: t IS NOT NULL), ',') AS texts,
      CAST(o_orderkey % 3 + 1 AS INTEGER) AS n_nodes
    FROM orders
    """
)
def path_lookups(spark, sf):
    """All texts below the first parent, and all nodes over all parents."""
    from ..functions.xmlpath import every_node, every_text

    text = node(
        "root",
        node("a", leaf("b", "concat(' ', o_orderpriority)"), leaf("b", "'  '"), leaf("b", "o_orderstatus"), leaf("b", "'x'")),
        repeated("o_orderkey % 3", lambda i: node("a", leaf("b", "'later'"), node("c", leaf("d", "'1'")))),
        node("a", node("c", leaf("d", "'2'"))),
    )
    schema = "a array<struct<b: array<string>, c: array<struct<d: array<string>>>>>"
    tree = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.expr(f"from_xml({text}, '{schema}')").alias("tree")
    )
    return tree.select(
        "o_orderkey", "o_custkey",
        F.array_join(F.expr(every_text("tree", "a/b")), ",").alias("texts"),
        F.size(F.expr(every_node("array(tree)", "a/c"))).alias("n_nodes"),
    )


def order_months(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").cast("smallint").alias("ano_emissao"),
        F.date_format("o_orderdate", "yyyyMM").alias("ref_aaaamm"),
    )


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) AS SMALLINT) AS ano_emissao, strftime(o_orderdate, '%Y%m') AS ref_aaaamm
       FROM orders WHERE year(o_orderdate) >= 1998"""
)
def min_year(spark, sf):
    from ..operators.rules import year_allowed

    return order_months(spark, sf).filter(year_allowed(F.col("ano_emissao"), 1998))


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) AS SMALLINT) AS ano_emissao, strftime(o_orderdate, '%Y%m') AS ref_aaaamm
       FROM orders WHERE strftime(o_orderdate, '%Y%m') IN ('199801', '199712', '199711') AND year(o_orderdate) >= 1997"""
)
def month_window(spark, sf):
    from datetime import date

    from ..operators.rules import month_window as window

    return order_months(spark, sf).filter(within_rules(1997, window(date.fromisoformat(NOW), 3)))


@query(
    """
    SELECT strftime(o_orderdate, '%Y%m') AS month_now, strftime(o_orderdate - to_months(CAST(i AS INTEGER)), '%Y%m') AS month,
      count(*) AS n
    FROM orders, generate_series(0, 3) AS g(i) GROUP BY ALL
    """
)
def month_window_rows(spark, sf):
    """The window of the four months up to each order, over all orders."""
    from ..operators.rules import month_window_column

    rows = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("month_now"),
        F.explode(month_window_column(F.col("o_orderdate").cast("date"), 4)).alias("month"),
    )
    return rows.groupBy("month_now", "month").agg(F.count(F.lit(1)).alias("n"))
