"""Fill-in-middle transformation with SWAR selection of the cut places.

The UTF-8 bytes of many texts lie one after the other and are viewed as 64-bit words. Arithmetic on whole
words marks each byte that ends a line (bit 7 of the byte), and bit counts per word with their running sum
give the number of line ends before any word. The place of a line end is then found by a search for its
word in the running sum and by a select of the remaining marks inside that word, for all texts at once.
Characters are counted in the same way: a byte that is not a continuation byte starts one.

A text of n lines is cut into prefix, middle and suffix after the smaller and the larger of two numbers
between 0 and n, which come from a SHA-256 of a seed and the id, as do the choice of a transformation and
of its form. So a row gives the same output in every run and in every partitioning.

Forms: ``plain`` is the text itself, ``psm`` is prefix, suffix, middle and ``spm`` suffix, prefix, middle,
each part after its mark. Texts that are empty or contain a mark stay plain, so the text can always be
rebuilt from the output and its form.

Defined results: a null text is empty; a last line without a line end is a line; a null id counts as an
empty one; repeated rows are transformed alike; an empty table gives an empty one; columns beyond those
named are ignored unless ``keep`` names them (it may not name a result column).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_fields, described

MARKS = ("<P>", "<S>", "<M>")
RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"

_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)
_LINE_END = np.uint64(0x0A0A0A0A0A0A0A0A)
_ONE = np.uint64(1)
#: Marks of the first 0 to 8 bytes of a word, which are its low ones.
_FIRST = np.array([(1 << 8 * count) - 1 for count in range(9)], np.uint64) & _HIGH
#: Bytes of texts that are worked on at once; a longer text is worked on alone.
PORTION = 8 << 20


class Places:
    """Marked bytes of a sequence of words: how many lie before a byte, and where the k-th one is."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each byte."""
        word, byte = np.divmod(at, 8)
        inside = np.bitwise_count(self.marks[np.minimum(word, len(self.marks) - 1)] & _FIRST[byte])
        return self.before[word] + inside

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte with k marked ones before it, for each k below their number."""
        word = np.searchsorted(self.before, k, side="right") - 1
        rest = k - self.before[word]
        marks = self.marks[word]
        for step in range(7):  # drops the lowest mark as long as there are marks to pass over
            marks = np.where(rest > step, marks & (marks - _ONE), marks)
        return word * 8 + np.bitwise_count((marks & (~marks + _ONE)) - _ONE).astype(np.int64) // 8


def line_ends(words: np.ndarray) -> np.ndarray:
    """Bit 7 of every byte that is a line end: an exact test for zero bytes, carries stay inside bytes."""
    other = words ^ _LINE_END
    return ~(((other & _LOW) + _LOW) | other | _LOW)


def character_starts(words: np.ndarray) -> np.ndarray:
    """Bit 7 of every byte other than 10xxxxxx."""
    return ~(words & ~(words << _ONE)) & _HIGH


def cut_places(data: np.ndarray, offsets: np.ndarray, one: np.ndarray, two: np.ndarray):
    """Lines, cut bytes and character counts of texts that lie between ``offsets`` in ``data``.

    ``one`` and ``two`` are unsigned numbers, taken modulo lines + 1.
    """
    words = np.zeros(len(data) // 8 + 1, np.uint64)
    words.view(np.uint8)[: len(data)] = data
    first, end = offsets[:-1], offsets[1:]
    ends, starts = Places(line_ends(words)), Places(character_starts(words))
    passed = ends.rank(first)
    closed = ends.rank(end) - passed
    open_end = (end > first) & (data[np.maximum(end, 1) - 1] != 10) if len(data) else np.zeros(len(first), bool)
    lines = closed + open_end
    a, b = one % (lines + 1), two % (lines + 1)
    cuts = []
    for units in (np.minimum(a, b), np.maximum(a, b)):
        cut = np.where(units == 0, first, end)
        inner = (units > 0) & (units <= closed)
        cut[inner] = ends.select(passed[inner] + units[inner] - 1) + 1
        cuts.append(cut)
    chars = [starts.rank(place) for place in (first, *cuts)]
    return lines, cuts[0], cuts[1], chars[1] - chars[0], chars[2] - chars[1]


def _tell_apart(marks: tuple[str, ...]) -> bool:
    """Whether text next to a mark can never look like one of the marks together with it."""
    overlap = any(a[-size:] == b[:size] for a in marks for b in marks for size in range(1, min(len(a), len(b))))
    inside = any(a in b for at, a in enumerate(marks) for to, b in enumerate(marks) if at != to)
    return len(marks) == 3 and all(marks) and not overlap and not inside


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lengths = np.concatenate(([0], np.cumsum(pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False), dtype=np.int64)))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(lengths, lengths[start] + PORTION, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def _transformer(marks: tuple[str, ...], rate: int, suffix_first: int, schema: pa.Schema):
    prefix_mark, suffix_mark, middle_mark = (mark.encode() for mark in marks)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _portions(batch):
                texts = rows.column(0).cast(pa.binary()).to_pylist()
                whole = b"".join(texts)
                offsets = np.concatenate(([0], np.cumsum([len(text) for text in texts]))).astype(np.int64)
                h1, h2, h3, h4 = (rows.column(at).to_numpy() for at in range(1, 5))
                lines, one, two, prefix, middle = cut_places(np.frombuffer(whole, np.uint8), offsets, h1, h2)
                forms, outputs, plain = [], [], np.zeros(len(texts), bool)
                for at, text in enumerate(texts):
                    if not text or h3[at] % 100 >= rate or prefix_mark in text or suffix_mark in text or middle_mark in text:
                        plain[at] = True
                        forms.append("plain")
                        outputs.append(text)
                        continue
                    a, b = one[at] - offsets[at], two[at] - offsets[at]
                    if h4[at] % 100 < suffix_first:
                        forms.append("spm")
                        outputs.append(b"".join((suffix_mark, text[b:], prefix_mark, text[:a], middle_mark, text[a:b])))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((prefix_mark, text[:a], suffix_mark, text[b:], middle_mark, text[a:b])))
                made = [
                    pa.array(lines), pa.array(forms, pa.string()), pa.array(prefix, mask=plain), pa.array(middle, mask=plain),
                    pa.array(outputs, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*made, *rows.columns[5:]], schema=schema)

    return transform


def fill_in_middle(
    documents: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    seed: int = 7,
    rate: int = 100,
    suffix_first: int = 50,
    marks: tuple[str, str, str] = MARKS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output)`` and the columns to ``keep``, for every row.

    ``rate`` is how many of 100 texts are transformed, ``suffix_first`` how many of 100 of these get the
    form ``spm``. The character counts are null for plain texts.
    """
    if not _tell_apart(marks):
        raise ValueError("three marks are needed that neither hold nor overlap each other or themselves")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))).cast("binary"), 256)
    numbers = [F.conv(F.substring(digest, 8 * at + 1, 8), 16, 10).cast("long").alias(f"_h{at}") for at in range(4)]
    rows = documents.select(
        F.coalesce(F.col(text), F.lit("")).alias("_text"), *numbers, F.col(id).alias("id"), *keep
    )
    made = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
    kept = ("id", *keep)
    schema = pa.schema([*made, *arrow_fields(rows, kept)])
    done = rows.mapInArrow(_transformer(marks, rate, suffix_first, schema), f"{RESULT}, {described(rows, kept)}")
    return done.select("id", *[name for name, _ in made], *keep)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from. A transformed output holds each mark exactly once."""
    parts = F.split(output, "|".join(re.escape(mark) for mark in marks))
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
