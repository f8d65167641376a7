"""Text clean-up and byte decoding."""

from __future__ import annotations

from . import literal

# The characters that count as blank at the ends of a value.
BLANKS = (
    " \t\n\r\u000b\u000c\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ASCII_BLANKS = " \t\n\r\u000b\u000c"

# Names under which an XML prolog may declare each supported charset.
UTF8_NAMES = ("", "utf-8", "utf8", "us-ascii", "ascii")
LATIN1_NAMES = ("iso-8859-1", "iso8859-1", "iso_8859-1", "latin1", "latin-1")
CP1252_NAMES = ("windows-1252", "cp1252")
LATIN9_NAMES = ("iso-8859-15", "iso8859-15", "iso_8859-15", "latin-9", "latin9")
# Others are turned into UTF-8 by the reader, see ``sources.archives``.
KNOWN_NAMES = (*UTF8_NAMES, *LATIN1_NAMES, *CP1252_NAMES, *LATIN9_NAMES, "utf-16", "utf-16le", "utf-16be")

# Windows-1252 differs from ISO-8859-1 only in 0x80-0x9F; undefined positions are left alone.
_CP1252_BYTES = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))

# ISO-8859-15 differs from ISO-8859-1 in eight places.
_LATIN9_BYTES = bytes(b for b in range(0xA0, 0x100) if bytes([b]).decode("latin-1") != bytes([b]).decode("iso8859-15"))

_DECLARATION = r"""^[^<]*<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._-]+)["']"""


def clean(value: str) -> str:
    """Trimmed text, NULL when nothing is left."""
    return f"nullif(btrim({value}, {literal(BLANKS)}), '')"


def clean_parsed(value: str) -> str:
    """Same as :func:`clean` for text that the XML parser has already stripped of ASCII blanks.

    Text of one byte per character can then have no blanks left at its ends.
    """
    return (
        f"if(octet_length({value}) = length({value}), if({value} = '', null, {value}), {clean(value)})"
    )


def join_texts(values: str, separator: str = "|") -> str:
    """Non-blank entries joined in order, NULL when there are none."""
    kept = f"filter(transform({values}, t -> {clean('t')}), t -> t is not null)"
    return f"nullif(array_join({kept}, {literal(separator)}), '')"


def quoted(value: str) -> str:
    """Text in quotes for a message: single quotes unless only those occur inside."""
    body = f"replace({value}, {literal(chr(92))}, {literal(chr(92) * 2)})"
    for char, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = f"replace({body}, {literal(char)}, {literal(escape)})"
    single, double = literal("'"), literal('"')
    return (
        f"if(contains({value}, {single}) and not contains({value}, {double}), "
        f"concat({double}, {body}, {double}), "
        f"concat({single}, replace({body}, {single}, {literal(chr(92) + chr(39))}), {single}))"
    )


def strip_start(text: str) -> str:
    """Text without the blanks and the byte-order mark in front of an XML document."""
    unblanked = f"ltrim({literal(ASCII_BLANKS)}, {text})"
    mark = literal("\ufeff")
    return f"if(startswith({unblanked}, {mark}), substring({unblanked}, 2), {unblanked})"


def is_blank(content: str) -> str:
    """True for bytes that are empty or only blanks, whatever their charset."""
    latin1 = f"decode({content}, 'ISO-8859-1')"
    # The first byte settles it for nearly all documents.
    maybe = f"contains({literal(ASCII_BLANKS)}, substring(decode(substring({content}, 1, 1), 'ISO-8859-1'), 1, 1))"
    return (
        f"case when octet_length({content}) = 0 then true "
        f"when {maybe} then btrim({latin1}, {literal(ASCII_BLANKS)}) = '' "
        f"when {content} is not null then false end"
    )


def _well_formed_utf16(content: str, big_endian: bool) -> str:
    unit = "[0-9A-F]{2}"
    if big_endian:
        plain, lead, trail = f"(?!D[89A-F]){unit}{unit}", f"D[89AB]{unit}", f"D[C-F]{unit}"
    else:
        plain, lead, trail = f"{unit}(?!D[89A-F]){unit}", f"{unit}D[89AB]", f"{unit}D[C-F]"
    return f"hex({content}) rlike {literal(f'^(?:{plain}|{lead}{trail})*+$')}"


def _among(value: str, names: tuple[str, ...]) -> str:
    return f"{value} in ({', '.join(literal(n) for n in names)})"


def decode_document(content: str) -> str:
    """Bytes of an XML document to text, by byte-order mark, else by the declared encoding.

    NULL when the bytes are not valid in that charset or the charset is not known, so that such
    a document ends up in quarantine instead of failing the job. Leading blanks and the
    byte-order mark are removed. The declaration is read to its end, however far that is.
    """
    head = f"hex(substring({content}, 1, 4))"
    letters = f"cast({content} as string)"
    prolog = f"substring({letters}, 1, instr({letters}, '?>'))"
    declared = f"lower(regexp_extract({prolog}, {literal(_DECLARATION)}, 1))"
    as_utf8 = f"cast({content} as string)"
    utf8 = f"if(is_valid_utf8({as_utf8}), {as_utf8}, null)"
    latin1 = f"decode({content}, 'ISO-8859-1')"
    cp1252 = (
        f"translate({latin1}, {literal(_CP1252_BYTES.decode('latin-1'))}, "
        f"{literal(_CP1252_BYTES.decode('cp1252'))})"
    )

    latin9 = (
        f"translate({latin1}, {literal(_LATIN9_BYTES.decode('latin-1'))}, "
        f"{literal(_LATIN9_BYTES.decode('iso8859-15'))})"
    )

    def utf16(big_endian: bool) -> str:
        charset = "UTF-16BE" if big_endian else "UTF-16LE"
        return (
            f"if({_well_formed_utf16(content, big_endian)}, decode({content}, '{charset}'), null)"
        )

    # UTF-16 without a mark shows as a zero byte next to the first "<".
    text = (
        f"case when {head} like 'EFBBBF%' then {utf8} "
        f"when {head} like 'FEFF%' or {head} like '003C%' then {utf16(True)} "
        f"when {head} like 'FFFE%' or {head} like '3C00%' then {utf16(False)} "
        f"when {_among(declared, UTF8_NAMES)} then {utf8} "
        f"when {_among(declared, LATIN1_NAMES)} then {latin1} "
        f"when {_among(declared, CP1252_NAMES)} then {cp1252} "
        f"when {_among(declared, LATIN9_NAMES)} then {latin9} end"
    )
    return strip_start(text)
