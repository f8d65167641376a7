from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from xml_samples import invoice, waybill

from tributary import fields as X
from tributary.plans.documents import PROVENANCE, both_rows, freight_rows, invoice_rows, parse_documents
from tributary.schemas import CTE_SCHEMA, NFE_SCHEMA


def minimal(inner: str, head: str = "", tail: str = "") -> str:
    return f"{head}<NFe><infNFe Id='NFe7'><ide><natOp>{inner}</natOp></ide></infNFe></NFe>{tail}"


CASES = {
    "invoice": invoice(),
    "waybill": waybill(),
    "border": invoice(issued="2026-01-31T23:30:00.123456-03:00"),
    "old": b"<NFe><infNFe Id='NFe35'><ide><dEmi>2026-01-22</dEmi></ide></infNFe></NFe>",
    "empty": b"",
    "blank": b"   \n\t  ",
    "truncated": b"<nfe>TRUNC",
    "junk after": minimal("x", tail="zz").encode(),
    "two roots": minimal("x", tail="<NFe/>").encode(),
    "comment after": minimal("x", tail="\n<!-- </NFe> --> ").encode(),
    "no body": b"<nfeProc><NFe><other/></NFe></nfeProc>",
    "no body, self-closed": b"<nfeProc><NFe/></nfeProc>",
    "only a root": b"<?xml version='1.0'?>\n<NFe/>",
    "waybill without body": b"<cteProc><CTe><other/></CTe></cteProc>",
    "other root": b"\xef\xbb\xbf<root/>",
    "latin1": minimal("São", "<?xml version='1.0' encoding=\"ISO-8859-1\"?>").encode("latin-1"),
    "late declaration": minimal("São", " " * 900 + "\n<?xml version='1.0'" + " " * 500 + "encoding='ISO-8859-1'?>").encode("latin-1"),
    "latin9": minimal("€ é", "<?xml version='1.0' encoding='ISO-8859-15'?>").encode("iso8859-15"),
    "cp1252": minimal("€", "<?xml version='1.0' encoding='windows-1252'?>").encode("cp1252"),
    "utf16": minimal("€\U0001f600", "<?xml version='1.0' encoding='UTF-16'?>").encode("utf-16"),
    "utf16 without mark": minimal("€").encode("utf-16-le"),
    "bad utf16": minimal("x").encode("utf-16") + b"\x00\xd8",
    "bad utf8": minimal("S").encode().replace(b"S", b"\xe3"),
    "unknown charset": minimal("x", "<?xml version='1.0' encoding='EBCDIC-X'?>").encode(),
    "prefixed": b"<p:NFe xmlns:p='u'><p:infNFe Id='NFe8'><p:ide><p:natOp>q</p:natOp></p:ide></p:infNFe></p:NFe>",
    "deep": b"<env><a><NFe><infNFe Id='NFe77'><ide><natOp>d</natOp></ide></infNFe></NFe>"
    b"<b><protNFe><infProt><chNFe>KEY</chNFe></infProt></protNFe></b></a></env>",
    "repeats": b"<NFe><infNFe Id='NFe1'><ide><natOp>one</natOp><natOp>two</natOp></ide><ide><natOp>three</natOp></ide></infNFe></NFe>",
    "no key": b"<NFe><infNFe><ide><natOp>\xc2\xa0 n \xc2\xa0</natOp></ide></infNFe></NFe>",
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(name, bytearray(content)) for name, content in CASES.items()]
    df = spark.createDataFrame(rows, "source_file_path string, content binary").repartition(2)
    missing = [c for c in PROVENANCE if c not in df.columns]
    times = ("source_file_mtime", "ingested_at")
    df = df.withColumns(
        {c: F.lit(None).cast("timestamp_ntz" if c in times else "string") for c in missing}
    )
    return parse_documents(df)


@pytest.fixture(scope="module")
def outcomes(parsed):
    rows = parsed.select(
        "source_file_path", "kind", "outcome", "error_type", "dhEmi", X.MONTH_COLUMN, "ano_emissao"
    ).collect()
    return {r["source_file_path"]: r for r in rows}


@pytest.fixture(scope="module")
def invoices(parsed):
    return {r["source_file_path"]: r for r in invoice_rows(parsed).collect()}


@pytest.mark.parametrize(
    "case, kind, outcome",
    [
        ("invoice", "nfe", "parsed"), ("waybill", "cte", "parsed"), ("old", "nfe", "parsed"),
        ("empty", None, "empty"), ("blank", None, "empty"),
        ("truncated", None, "corrupt"), ("junk after", None, "corrupt"), ("two roots", None, "corrupt"),
        ("comment after", "nfe", "parsed"), ("no body", "nfe", "no_body"),
        ("no body, self-closed", "nfe", "no_body"), ("only a root", "nfe", "no_body"),
        ("waybill without body", "cte", "no_body"), ("other root", "nfe", "no_body"),
        ("latin1", "nfe", "parsed"), ("late declaration", "nfe", "parsed"), ("latin9", "nfe", "parsed"), ("cp1252", "nfe", "parsed"), ("utf16", "nfe", "parsed"),
        ("utf16 without mark", "nfe", "parsed"), ("bad utf16", None, "corrupt"),
        ("bad utf8", None, "corrupt"), ("unknown charset", None, "corrupt"),
        ("prefixed", "nfe", "parsed"), ("deep", "nfe", "parsed"),
    ],
)
def test_classification(outcomes, case, kind, outcome):
    assert (outcomes[case]["kind"], outcomes[case]["outcome"]) == (kind, outcome)


def test_error_types(outcomes):
    assert outcomes["truncated"]["error_type"] == "XMLSyntaxError"
    assert outcomes["bad utf8"]["error_type"] == "UnicodeDecodeError"
    assert outcomes["invoice"]["error_type"] is None


def test_month_is_the_documents_own_and_instant_is_utc(outcomes):
    row = outcomes["border"]
    assert row[X.MONTH_COLUMN] == "202601"
    assert row["dhEmi"] == dt.datetime(2026, 2, 1, 2, 30, 0, 123000)


def test_invoice_columns(spark, parsed, invoices):
    assert [(f.name, f.dataType) for f in invoice_rows(parsed).schema] == [
        (f.name, f.dataType) for f in NFE_SCHEMA
    ]
    row = invoices["invoice"]
    assert row["chNFe"] == "1" * 44 and row["nNF"] == "48213" and row["natOp"] == "LOAN"
    assert row["dhEmi"] == dt.datetime(2026, 2, 17, 19, 45)
    assert (row["ano_emissao"], row["mes_emissao"], row["ref_aaaamm"]) == (2026, 2, "202602")
    assert row["refNFe"] == "R1|R2"
    assert row["dest_CNPJ"] is None and row["emit_UF"] == "PA" and row["emit_xMun"] == "MARABA"
    assert row["vBC"] == Decimal("66.5") and row["vDesc"] == Decimal("0.75") and row["vICMS"] is None
    assert row["itens_cProd"] == ["A", None, "C"]
    assert row["itens_PIS_CST"] == ["03", None, None]
    assert row["itens_qCom"] == [Decimal(7), None, None]
    assert row["dup_nDup"] == ["7a", "7b"]
    assert row["dup_dVenc"] == [dt.date(2026, 5, 9), None]
    assert row["pag_tPag"] == ["90"]
    assert row["parser_warnings"] == [
        "decimal inválido em vICMS: 'oops'",
        "decimal inválido em itens_qCom: 'bad'",
    ]


def test_date_and_key_fallback(invoices):
    row = invoices["old"]
    assert row["dhEmi"] == dt.datetime(2026, 1, 22) and row["chNFe"] == "35"
    assert row["parser_warnings"] == [X.WARN_NFE_DATE_FALLBACK, X.WARN_NFE_KEY_FALLBACK]
    assert row["itens_cProd"] == [] and row["dup_nDup"] == []
    assert invoices["no key"]["parser_warnings"] == [X.WARN_NFE_NO_DATE, X.WARN_NFE_NO_KEY]


@pytest.mark.parametrize(
    "case, text",
    [
        ("latin1", "São"), ("late declaration", "São"), ("latin9", "€ é"), ("cp1252", "€"), ("utf16", "€\U0001f600"),
        ("utf16 without mark", "€"), ("prefixed", "q"), ("deep", "d"), ("repeats", "one"),
        ("no key", "n"),
    ],
)
def test_texts(invoices, case, text):
    assert invoices[case]["natOp"] == text


def test_protocol_at_any_depth(invoices):
    assert invoices["deep"]["chNFe"] == "KEY"


def test_document_without_body_has_only_metadata(invoices):
    row = invoices["no body"].asDict()
    assert {k for k, v in row.items() if v is not None} == {"source_file_path"}


def test_waybill_columns(parsed):
    df = freight_rows(parsed)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CTE_SCHEMA]
    row = {r["source_file_path"]: r for r in df.collect()}["waybill"]
    assert row["chCTe"] == "2" * 44 and row["serie"] == "021" and row["toma"] == "0" and row["cStat"] == "135"
    assert row["vTPrest"] == Decimal(40) and row["vICMS00"] == Decimal("4.8") and row["vICMS10"] is None
    assert row["infQ_qCarga"] == [Decimal("31.25"), None]
    assert row["infNFe_chave"] == ["K1", "K2"] and row["transp_qVol"] == []
    assert row["parser_warnings"] == [
        "decimal inválido em vCarga: 'x1'",
        "decimal inválido em infQ_qCarga: 'bad'",
    ]


def test_both_rows_agree_with_the_single_tables(parsed, invoices):
    both = both_rows(parsed, "outcome = 'parsed'", ["source_file_path"])
    rows = {r["source_file_path"]: r for r in both.collect()}
    assert rows["invoice"]["nfe"] == invoices["invoice"] and rows["invoice"]["cte"] is None
    assert rows["waybill"]["cte"]["nCT"] == "77" and rows["waybill"]["nfe"] is None
    assert rows["no body"]["nfe"] is None and len(rows) == len(CASES)


def test_each_document_is_parsed_once(spark, parsed):
    # Two calls: the parse, and the one that is made only for bodies below the first level.
    filtered = invoice_rows(parsed.filter("ref_aaaamm = '202602' and ano_emissao >= 2026"))
    old = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = filtered._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", old)
    assert len(re.findall(r"from_xml\(|xmltostructs\(", plan.lower())) == 2


def test_only_texts_that_are_asked_for_are_computed(spark, parsed):
    old = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = invoice_rows(parsed).select("nNF")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", old)
    assert "ide[0].nNF[0]" in plan
    assert "infAdic[0].infCpl[0]" not in plan and "emit[0].xNome[0]" not in plan


def test_element_ends_at_its_own_closing_tag(spark):
    from tributary.plans.documents import element_at_depth, without_sections

    cases = {
        "<x><NFe><a/></NFe><b/></x>": "<NFe><a/></NFe>",
        "<x><NFe><o><NFe>i</NFe><NFe/></o></NFe><b/></x>": "<NFe><o><NFe>i</NFe><NFe/></o></NFe>",
        "<x><NFe/><y><NFe>1</NFe></y></x>": "<NFe/>",
        "<x><NFe/><NFe/></x>": "<NFe/>",
        "<x><n:NFe k='>'><m:NFe>1</m:NFe></n:NFe></x>": "<n:NFe k='>'><m:NFe>1</m:NFe></n:NFe>",
        "<x><NFe>1</NFe ><b/></x>": "<NFe>1</NFe >",
        "<x><NFe k=\"a>'b\">1</NFe><NFe>2</NFe></x>": "<NFe k=\"a>'b\">1</NFe>",
        "<x><NFes/><infNFe>1</infNFe></x>": "",
        "<x/>": "",
        "<x><!-- <NFe>0</NFe> --><NFe><![CDATA[</NFe>]]></NFe></x>": "<NFe>&lt;/NFe&gt;</NFe>",
        None: None,
    }
    bare = spark.createDataFrame([(text,) for text in cases], "text string").selectExpr("text", f"{without_sections('text')} as bare")
    rows = bare.selectExpr("text", f"{element_at_depth('bare', 'NFe')} as found")
    assert {r["text"]: r["found"] for r in rows.collect()} == cases
