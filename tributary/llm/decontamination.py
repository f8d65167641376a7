"""Benchmark decontamination by one Aho-Corasick automaton over normalised test items.

Items are normalised to lower-case words and cut into windows of consecutive words (a shorter item
is one window). The windows, as sequences of word numbers, make one automaton; each document is
turned into word numbers once and passes through it once. Every word keeps its byte offsets, so hits
are reported as places in the original text.

Items are read in portions of a bounded number of windows (``windows_per_pass``). A benchmark beyond
that bound is scanned in several passes whose hits are merged per document; nothing is left out.

Defined results: a null or empty text has no words and no hits; an item without words has no window
and never counts; equal items count each by its own id; repeated rows of an item count once; columns
beyond those named are ignored. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_fields, described

#: Delimiters 00-2F, 3A-60 (after lower-casing) and 7B-7F become blanks; bytes of other letters stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD_BYTE = np.array([chr(b) != " " for b in _FOLD])

HITS = "n_words long, n_hit long, items array<string>, first_byte array<long>, end_byte array<long>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


def word_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word in the UTF-8 form of the original text."""
    inside = _WORD_BYTE[np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return edges[0::2], edges[1::2]


def windows_of(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    if len(words) <= width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


class Matcher:
    """Automaton over the windows of a bounded set of items."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        import ahocorasick

        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            for window in windows_of(words_of(text), width):
                owners.setdefault(window, set()).add(item)
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, ids in owners.items():
            key = tuple(self.numbers.setdefault(word, len(self.numbers) + 1) for word in window)
            self.automaton.add_word(key, (len(key), tuple(sorted(ids))))
        self.empty = not owners
        if not self.empty:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Numbers of the words inside any window, and the items whose windows occur."""
        if self.empty or not words:
            return np.empty(0, np.int64), []
        number = self.numbers.get
        items: set[str] = set()
        change = None
        for end, (length, ids) in self.automaton.iter(tuple([number(word, 0) for word in words])):
            if change is None:
                change = np.zeros(len(words) + 1, np.int32)
            change[end - length + 1] += 1
            change[end + 1] -= 1
            items.update(ids)
        if change is None:
            return np.empty(0, np.int64), []
        return np.flatnonzero(np.cumsum(change[:-1])), sorted(items)


def _result_schema(rows: DataFrame, before: tuple[str, ...], keep: tuple[str, ...]) -> pa.Schema:
    hits = [
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
        ("first_byte", pa.list_(pa.int64())), ("end_byte", pa.list_(pa.int64())),
    ]
    return pa.schema([*arrow_fields(rows, before), *hits, *arrow_fields(rows, keep)])


def _stretches(text: str, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte places of the runs of hit words."""
    first, end = word_bounds(text)
    breaks = np.flatnonzero(np.diff(found) > 1)
    return first[found[np.concatenate(([0], breaks + 1))]], end[found[np.concatenate((breaks, [len(found) - 1]))]]


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return [pa.array(list(values), kind) for values, kind in zip(columns, kinds)]


def _scanner(shared, width: int, schema: pa.Schema):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = None
        for batch in batches:
            matcher = matcher or Matcher(shared.value, width)
            rows = []
            for text in batch.column(2):
                text = text.as_py()
                words = words_of(text)
                found, ids = matcher.scan(words)
                rows.append((len(words), len(found), ids, *(_stretches(text, found) if len(found) else ([], []))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *_columns(rows), *batch.columns[3:]], schema=schema)

    return scan


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 10,
    windows_per_pass: int = 500_000,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: ``(id, n_words, n_hit, items, first_byte, end_byte, *keep)``.

    ``first_byte`` and ``end_byte`` are the hit stretches in the UTF-8 form of the original text.
    """
    docs = documents.select(F.col(id).alias("id"), F.xxhash64(text).alias("_mark"), F.col(text).alias("_text"), *keep)
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("words")).where(
        F.col("item").isNotNull() & F.col("words").isNotNull()
    )
    # No item has more windows than every other byte of its text.
    bound = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    passes = max(1, math.ceil(bound / 2 / windows_per_pass))
    context = documents.sparkSession.sparkContext
    scans = []
    for number in range(passes):
        portion = items if passes == 1 else items.where(F.pmod(F.xxhash64("item", "words"), F.lit(passes)) == number)
        shared = context.broadcast([tuple(row) for row in portion.distinct().collect()])
        carried = keep if passes == 1 else ()
        rows = docs.select("id", "_mark", "_text", *carried)
        schema = _result_schema(rows, ("id", "_mark"), carried)
        scans.append(rows.mapInArrow(_scanner(shared, width, schema), _described(rows, ("id", "_mark"), carried)))
    if passes == 1:
        return scans[0].drop("_mark")
    # Equal texts of one id have equal hits, so that (id, mark) is enough of a key.
    gathered = (
        reduce(DataFrame.unionByName, scans)
        .where("n_hit > 0")
        .groupBy(F.col("id").alias("_id"), F.col("_mark").alias("_same"))
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_items"),
            F.flatten(F.collect_set(F.arrays_zip("first_byte", "end_byte"))).alias("_stretches"),
        )
    )
    same = docs["id"].eqNullSafe(gathered["_id"]) & (docs["_mark"] == gathered["_same"])
    rows = docs.join(gathered, same, "left").select("id", "_text", "_items", "_stretches", *keep)
    return rows.mapInArrow(_merger(_result_schema(rows, ("id",), keep)), _described(rows, ("id",), keep))


def _described(rows: DataFrame, before: tuple[str, ...], keep: tuple[str, ...]) -> str:
    return ", ".join(filter(None, (described(rows, before), HITS, described(rows, keep))))


def _merger(schema: pa.Schema):
    def merge(batches):
        for batch in batches:
            rows = []
            for text, items, stretches in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                first, end = word_bounds(text or "")
                change = np.zeros(len(first) + 1, np.int64)
                for place in stretches or []:
                    change[np.searchsorted(first, place["first_byte"])] += 1
                    change[np.searchsorted(end, place["end_byte"]) + 1] -= 1
                found = np.flatnonzero(np.cumsum(change[:-1]))
                places = _stretches(text, found) if len(found) else ([], [])
                rows.append((len(first), len(found), items or [], *places))
            yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(rows), *batch.columns[4:]], schema=schema)

    return merge
