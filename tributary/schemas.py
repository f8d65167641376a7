"""Spark schemas of the stored tables and of the XML parse tree, derived from the field tables."""

from __future__ import annotations

from pyspark.sql import types as T

from . import fields as X

DECIMAL = T.DecimalType(38, 12)
_ELEMENT_TYPES = {"text": T.StringType(), "decimal": DECIMAL}

_SPECIAL: dict[str, T.DataType] = {
    "dhEmi": T.TimestampNTZType(),
    "refNFe": T.StringType(),
    "chNFe": T.StringType(),
    "chCTe": T.StringType(),
    "cStat": T.StringType(),
    "ano_emissao": T.ShortType(),
    "mes_emissao": T.ByteType(),
    "dup_nDup": T.ArrayType(T.StringType()),
    "dup_dVenc": T.ArrayType(T.DateType()),
    "pag_tPag": T.ArrayType(T.StringType()),
    "infQ_qCarga": T.ArrayType(DECIMAL),
    "infNFe_chave": T.ArrayType(T.StringType()),
    "transp_qVol": T.ArrayType(DECIMAL),
    "source_file_mtime": T.TimestampNTZType(),
    "ingested_at": T.TimestampNTZType(),
    "parser_warnings": T.ArrayType(T.StringType()),
}


def _table_schema(order: list[str], scalars: list[X.Field], items: list[X.Field]) -> T.StructType:
    kinds: dict[str, T.DataType] = {f.column: _ELEMENT_TYPES[f.type] for f in scalars}
    kinds.update({f.column: T.ArrayType(_ELEMENT_TYPES[f.type]) for f in items})
    kinds.update(_SPECIAL)
    names = order + X.METADATA_COLUMN_ORDER
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])


NFE_SCHEMA = _table_schema(X.NFE_COLUMN_ORDER, X.NFE_SCALARS, X.NFE_ITEMS)
CTE_SCHEMA = _table_schema(X.CTE_COLUMN_ORDER, X.CTE_SCALARS, [])


# --------------------------------------------------------------------------- XML parse tree

CORRUPT_COLUMN = "_corrupt"


def _tree(paths: list[str]) -> dict:
    root: dict = {}
    for path in paths:
        node = root
        for part in path.split("/"):
            node = node.setdefault(part, {})
    return root


def _struct(tree: dict, attributes: tuple[str, ...] = ()) -> T.StructType:
    # Every element is declared as an array: from_xml then keeps all repeats in document order,
    # so that "first one wins" can be expressed as element 0 of each level.
    attrs = [T.StructField("_" + a, T.StringType()) for a in attributes]
    return T.StructType(
        attrs
        + [
            T.StructField(name, T.ArrayType(_struct(sub) if sub else T.StringType()))
            for name, sub in tree.items()
        ]
    )


def document_schema() -> T.StructType:
    """Parse schema that accepts either layout, with or without its outer wrapper element."""
    nfe_paths = [f.path for f in X.NFE_SCALARS] + ["det/" + f.path for f in X.NFE_ITEMS]
    nfe_paths += ["ide/dhEmi", "ide/dEmi", "ide/NFref/refNFe"]
    nfe_paths += ["cobr/dup/nDup", "cobr/dup/dVenc", "pag/detPag/tPag"]
    cte_paths = [f.path for f in X.CTE_SCALARS]
    cte_paths += ["ide/dhEmi", "infCTeNorm/infCarga/infQ/qCarga"]
    cte_paths += ["infCTeNorm/infDoc/infNFe/chave", "transp/vol/qVol"]

    inf_nfe = T.ArrayType(_struct(_tree(nfe_paths), ("Id",)))
    inf_cte = T.ArrayType(_struct(_tree(cte_paths), ("Id",)))

    def wrapped(name: str, body: T.DataType) -> T.ArrayType:
        return T.ArrayType(T.StructType([T.StructField(name, body)]))

    return T.StructType(
        [
            T.StructField("infNFe", inf_nfe),
            T.StructField("NFe", wrapped("infNFe", inf_nfe)),
            T.StructField("protNFe", T.ArrayType(_struct(_tree(["infProt/chNFe"])))),
            T.StructField("infCte", inf_cte),
            T.StructField("CTe", wrapped("infCte", inf_cte)),
            T.StructField("protCTe", T.ArrayType(_struct(_tree(["infProt/chCTe", "infProt/cStat"])))),
            T.StructField(CORRUPT_COLUMN, T.StringType()),
        ]
    )


# --------------------------------------------------------------------------- state tables

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_file_path", T.StringType()),
        T.StructField("source_entry_path", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("processed_at", T.TimestampNTZType()),
        T.StructField("ref_aaaamm", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("notes", T.StringType()),
    ]
)

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("source_entry_path", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("failed_at", T.TimestampNTZType()),
        T.StructField("retry_count", T.LongType()),
    ]
)
