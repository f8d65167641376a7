"""Fixed values of the two fiscal document layouts.

Every table below states values that must be exactly these for results to be right: output
column names and their order, element paths of the public document layouts, list groups,
warning texts and the order in which warnings are reported. Nothing here is logic.

``type`` is ``text`` (trimmed string) or ``decimal`` (exact number, warned about when unusable);
paths are local element names, ignoring namespaces, below ``infNFe`` / ``infCte``.
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------- goods invoice

NFE_SCALARS_TABLE = """
nNF                      text     ide/nNF
emit_CNPJ                text     emit/CNPJ
emit_xNome               text     emit/xNome
dest_CNPJ                text     dest/CNPJ
dest_xNome               text     dest/xNome
vBCST                    decimal  total/ICMSTot/vBCST
vDesc                    decimal  cobr/fat/vDesc
emit_UF                  text     emit/enderEmit/UF
dest_UF                  text     dest/enderDest/UF
emit_xMun                text     emit/enderEmit/xMun
dest_xMun                text     dest/enderDest/xMun
cMunFG                   text     ide/cMunFG
natOp                    text     ide/natOp
mod                      text     ide/mod
tpNF                     text     ide/tpNF
finNFe                   text     ide/finNFe
qBCMonoRet               decimal  imposto/ICMS/ICMS61/qBCMonoRet
modFrete                 text     transp/modFrete
infCpl                   text     infAdic/infCpl
transp_transporta_xNome  text     transp/transporta/xNome
transp_transporta_CNPJ   text     transp/transporta/CNPJ
transp_veic_placa        text     transp/veicTransp/placa
vBCIBSCBS                decimal  total/IBSCBSTot/vBCIBSCBS
vBC                      decimal  total/ICMSTot/vBC
vICMS                    decimal  total/ICMSTot/vICMS
vICMSDeson               decimal  total/ICMSTot/vICMSDeson
vFCP                     decimal  total/ICMSTot/vFCP
vST                      decimal  total/ICMSTot/vST
vFCPST                   decimal  total/ICMSTot/vFCPST
vFCPSTRet                decimal  total/ICMSTot/vFCPSTRet
qBCMono                  decimal  total/ICMSTot/qBCMono
vICMSMono                decimal  total/ICMSTot/vICMSMono
qBCMonoReten             decimal  total/ICMSTot/qBCMonoReten
vICMSMonoReten           decimal  total/ICMSTot/vICMSMonoReten
vII                      decimal  total/ICMSTot/vII
vIPI                     decimal  total/ICMSTot/vIPI
vIPIDevol                decimal  total/ICMSTot/vIPIDevol
vPIS                     decimal  total/ICMSTot/vPIS
vCOFINS                  decimal  total/ICMSTot/vCOFINS
vOutro                   decimal  total/ICMSTot/vOutro
vFrete                   decimal  total/ICMSTot/vFrete
vSeg                     decimal  total/ICMSTot/vSeg
vNFTot                   decimal  total/vNFTot
"""

# Paths below one ``det`` element.
NFE_ITEMS_TABLE = """
itens_cProd                  text     prod/cProd
itens_xProd                  text     prod/xProd
itens_CFOP                   text     prod/CFOP
itens_qCom                   decimal  prod/qCom
itens_uCom                   text     prod/uCom
itens_vUnCom                 decimal  prod/vUnCom
itens_vProd                  decimal  prod/vProd
itens_IBSCBS_CST             text     imposto/IBSCBS/CST
itens_IBSCBS_cClassTrib      text     imposto/IBSCBS/cClassTrib
itens_COFINS_CST             text     imposto/COFINS/COFINSQtde/CST
itens_COFINS_qBCProd         decimal  imposto/COFINS/COFINSQtde/qBCProd
itens_COFINS_vAliqProd       decimal  imposto/COFINS/COFINSQtde/vAliqProd
itens_COFINS_vCOFINS         decimal  imposto/COFINS/COFINSQtde/vCOFINS
itens_PIS_CST                text     imposto/PIS/PISQtde/CST
itens_PIS_qBCProd            decimal  imposto/PIS/PISQtde/qBCProd
itens_PIS_vAliqProd          decimal  imposto/PIS/PISQtde/vAliqProd
itens_PIS_vPIS               decimal  imposto/PIS/PISQtde/vPIS
itens_ICMS15_orig            text     imposto/ICMS/ICMS15/orig
itens_ICMS15_CST             text     imposto/ICMS/ICMS15/CST
itens_ICMS15_qBCMono         decimal  imposto/ICMS/ICMS15/qBCMono
itens_ICMS15_adRemICMS       decimal  imposto/ICMS/ICMS15/adRemICMS
itens_ICMS15_vICMSMono       decimal  imposto/ICMS/ICMS15/vICMSMono
itens_ICMS15_qBCMonoReten    decimal  imposto/ICMS/ICMS15/qBCMonoReten
itens_ICMS15_adRemICMSReten  decimal  imposto/ICMS/ICMS15/adRemICMSReten
itens_ICMS15_vICMSMonoReten  decimal  imposto/ICMS/ICMS15/vICMSMonoReten
"""

NFE_COLUMN_ORDER = """
dhEmi nNF emit_CNPJ emit_xNome dest_CNPJ dest_xNome vBCST vDesc emit_UF dest_UF emit_xMun dest_xMun
chNFe cMunFG natOp mod tpNF finNFe refNFe qBCMonoRet modFrete infCpl
transp_transporta_xNome transp_transporta_CNPJ transp_veic_placa
vBCIBSCBS vBC vICMS vICMSDeson vFCP vST vFCPST vFCPSTRet qBCMono vICMSMono qBCMonoReten vICMSMonoReten
vII vIPI vIPIDevol vPIS vCOFINS vOutro vFrete vSeg vNFTot
itens_cProd itens_xProd itens_CFOP itens_qCom itens_uCom itens_vUnCom itens_vProd
itens_IBSCBS_CST itens_IBSCBS_cClassTrib
itens_COFINS_CST itens_COFINS_qBCProd itens_COFINS_vAliqProd itens_COFINS_vCOFINS
itens_PIS_CST itens_PIS_qBCProd itens_PIS_vAliqProd itens_PIS_vPIS
itens_ICMS15_orig itens_ICMS15_CST itens_ICMS15_qBCMono itens_ICMS15_adRemICMS itens_ICMS15_vICMSMono
itens_ICMS15_qBCMonoReten itens_ICMS15_adRemICMSReten itens_ICMS15_vICMSMonoReten
dup_nDup dup_dVenc pag_tPag ano_emissao mes_emissao
""".split()

# Order in which unusable numbers are reported: totals first, then item by item.
NFE_SCALAR_WARNING_ORDER = """
vBCST vDesc vBCIBSCBS vBC vICMS vICMSDeson vFCP vST vFCPST vFCPSTRet qBCMono vICMSMono
qBCMonoReten vICMSMonoReten vII vIPI vIPIDevol vPIS vCOFINS vOutro vFrete vSeg vNFTot qBCMonoRet
""".split()
NFE_ITEM_WARNING_ORDER = """
itens_qCom itens_vProd itens_vUnCom
itens_COFINS_qBCProd itens_COFINS_vAliqProd itens_COFINS_vCOFINS
itens_PIS_qBCProd itens_PIS_vAliqProd itens_PIS_vPIS
itens_ICMS15_qBCMono itens_ICMS15_adRemICMS itens_ICMS15_vICMSMono
itens_ICMS15_qBCMonoReten itens_ICMS15_adRemICMSReten itens_ICMS15_vICMSMonoReten
""".split()

# --------------------------------------------------------------------------- freight waybill

CTE_SCALARS_TABLE = """
serie         text     ide/serie
nCT           text     ide/nCT
CFOP          text     ide/CFOP
natOp         text     ide/natOp
mod           text     ide/mod
xMunEnv       text     ide/xMunEnv
toma          text     ide/toma3/toma
emit_CNPJ     text     emit/CNPJ
emit_xNome    text     emit/xNome
emit_UF       text     emit/enderEmit/UF
emit_xMun     text     emit/enderEmit/xMun
dest_CNPJ     text     dest/CNPJ
dest_xNome    text     dest/xNome
dest_UF       text     dest/enderDest/UF
dest_xMun     text     dest/enderDest/xMun
rem_CNPJ      text     rem/CNPJ
rem_xNome     text     rem/xNome
rem_xMun      text     rem/enderReme/xMun
exped_xNome   text     exped/xNome
receb_xNome   text     receb/xNome
transp_xNome  text     transp/transporta/xNome
transp_CNPJ   text     transp/transporta/CNPJ
vCarga        decimal  infCTeNorm/infCarga/vCarga
proPred       text     infCTeNorm/infCarga/proPred
vTPrest       decimal  vPrest/vTPrest
vICMS00       decimal  imp/ICMS/ICMS00/vICMS
vICMS10       decimal  imp/ICMS/ICMS10/vICMS
xObs          text     compl/xObs
"""

CTE_COLUMN_ORDER = """
serie dhEmi nCT CFOP natOp mod xMunEnv toma
emit_CNPJ emit_xNome emit_UF emit_xMun dest_CNPJ dest_xNome dest_UF dest_xMun
rem_CNPJ rem_xNome rem_xMun exped_xNome receb_xNome transp_xNome transp_CNPJ
vCarga proPred vTPrest vICMS00 vICMS10 xObs chCTe cStat
infQ_qCarga infNFe_chave transp_qVol
""".split()

CTE_SCALAR_WARNING_ORDER = "vICMS00 vICMS10 vCarga vTPrest".split()

# --------------------------------------------------------------------------- common

METADATA_COLUMN_ORDER = """
ref_aaaamm source source_root source_file_path source_file_type source_entry_path
source_file_mtime ingested_at parser_warnings
""".split()

# Lists that belong together by position; different groups are independent of each other.
NFE_LIST_GROUPS = {
    "itens": [line.split()[0] for line in NFE_ITEMS_TABLE.strip().splitlines()],
    "dup": ["dup_nDup", "dup_dVenc"],
    "pag": ["pag_tPag"],
    "warn": ["parser_warnings"],
}
CTE_LIST_GROUPS = {
    "infQ": ["infQ_qCarga"],
    "infNFe": ["infNFe_chave"],
    "transp": ["transp_qVol"],
    "warn": ["parser_warnings"],
}

WARN_NFE_DATE_FALLBACK = "dhEmi ausente/ inválido; usado dEmi como fallback"
WARN_NFE_NO_DATE = "sem dhEmi/dEmi parseável"
WARN_NFE_KEY_FALLBACK = "chNFe via fallback infNFe/@Id"
WARN_NFE_NO_KEY = "chNFe ausente"
WARN_CTE_NO_DATE = "dhEmi ausente ou inválido"
WARN_CTE_KEY_FALLBACK = "chCTe via fallback infCte/@Id"
WARN_CTE_NO_KEY = "chCTe ausente"
WARN_DECIMAL_PREFIX = "decimal inválido em "

NFE_KEY, CTE_KEY = "chNFe", "chCTe"
CTE_ROOTS = ("cteProc", "CTe")
MONTH_COLUMN = "ref_aaaamm"
SEQUENCE_COLUMN = "item_seq"
FLAT_SUFFIX = "_flat"
MAX_ERROR_CHARS = 500
DEFAULT_MIN_YEAR = 2026
DEFAULT_WINDOW_MONTHS = 2


@dataclass(frozen=True)
class Field:
    column: str
    type: str
    path: str


def _table(text: str) -> list[Field]:
    return [Field(*line.split()) for line in text.strip().splitlines()]


NFE_SCALARS = _table(NFE_SCALARS_TABLE)
NFE_ITEMS = _table(NFE_ITEMS_TABLE)
CTE_SCALARS = _table(CTE_SCALARS_TABLE)
