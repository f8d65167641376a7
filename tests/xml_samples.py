"""Small documents with one property each; all values are made up."""

INVOICE = """<?xml version="1.0" encoding="UTF-8"?>
<nfeProc xmlns="http://www.portalfiscal.inf.br/nfe" versao="4.00"><NFe><infNFe Id="NFe{key}" versao="4.00">
  <ide><nNF>{number}</nNF><natOp>LOAN</natOp><tpNF>0</tpNF><serie>088</serie><mod>65</mod>
   <NFref><refNFe>R1</refNFe></NFref><NFref><refNFe> R2 </refNFe></NFref><NFref><refCTe>x</refCTe></NFref><dhEmi>{issued}</dhEmi></ide>
  <dest><CPF>98765432109</CPF><xNome>LENDER</xNome><enderDest><UF>AC</UF></enderDest></dest>
  <emit><xNome>MAKER</xNome><CNPJ>77777777000177</CNPJ><enderEmit><UF>PA</UF><xMun>MARABA</xMun></enderEmit></emit>
  <det nItem="1"><imposto><PIS><PISQtde><CST>03</CST><vPIS>0.35</vPIS></PISQtde></PIS></imposto>
   <prod><cProd>A</cProd><xProd>rope</xProd><uCom>M</uCom><CFOP>6908</CFOP><vProd>66.50</vProd><qCom>7.0000</qCom><vUnCom>9.5</vUnCom></prod></det>
  <det nItem="2"><imposto><PIS><PISQtde><CST>99</CST></PISQtde></PIS></imposto></det>
  <det nItem="3"><prod><qCom>bad</qCom><cProd>C</cProd></prod></det>
  <pag><detPag><tPag>90</tPag></detPag></pag>
  <cobr><dup><dVenc>2026-05-09</dVenc><nDup>7a</nDup></dup><dup><dVenc>soon</dVenc><nDup>7b</nDup></dup><fat><vDesc>0.75</vDesc></fat></cobr>
  <total><vNFTot>66.50</vNFTot><ICMSTot><vICMS>oops</vICMS><vDesc>3.00</vDesc><vBC>66.50</vBC></ICMSTot></total>
 </infNFe></NFe><protNFe><infProt><chNFe>{key}</chNFe></infProt></protNFe></nfeProc>"""

WAYBILL = """<cteProc xmlns="http://www.portalfiscal.inf.br/cte"><protCTe><infProt><cStat>135</cStat><chCTe>{key}</chCTe></infProt></protCTe>
 <CTe><infCte Id="CTe{key}">
  <infCTeNorm><infDoc><infNFe><chave>K1</chave></infNFe><infNFe><chave>K2</chave></infNFe></infDoc>
   <infCarga><infQ><qCarga>31.250</qCarga></infQ><infQ><qCarga>bad</qCarga></infQ><vCarga>x1</vCarga></infCarga>
   <infCarga><infQ><qCarga>9</qCarga></infQ></infCarga></infCTeNorm>
  <imp><ICMS><ICMS00><vICMS>4.80</vICMS></ICMS00></ICMS></imp><vPrest><vTPrest>40.00</vTPrest></vPrest>
  <ide><dhEmi>{issued}</dhEmi><toma3><toma>0</toma></toma3><nCT>77</nCT><serie>021</serie></ide>
 </infCte></CTe></cteProc>"""


def invoice(key="1" * 44, number="48213", issued="2026-02-17T16:45:00-03:00") -> bytes:
    return INVOICE.format(key=key, number=number, issued=issued).encode()


def waybill(key="2" * 44, issued="2026-02-04T20:15:00-03:00") -> bytes:
    return WAYBILL.format(key=key, issued=issued).encode()
