"""Spelling variant grouping: words one edit apart, found by asymmetric q-chunks.

Of two words that differ by one inserted, deleted or replaced character, the shorter one (either, if they
are as long) is cut into two disjoint chunks of half its length, its first and its last characters. One
edit leaves at least one of them whole. The other word gives its positional grams of the same length, and
a chunk meets an equal gram at most one place further on: at the same place if the words are as long, at
the same or the next place if the other is longer by one. Grams at places that no chunk can meet are not
made. Chunks and grams are joined on a hash of length, place and characters, and every pair is verified by
its edit distance.

A chunk may be common (a third of all words may begin alike). Pairs of a chunk with more than ``common``
possible pairs are not made: the part of the words that is still open is halved again, so that each half in turn is
demanded to be equal, until no chunk is common or a single character is open, where a group holds no more
words than there are characters. No pair is lost, since the edit is in one half or the other.

The form of a word is its near word with most occurrences, if it has at least ``ratio`` times as many; its
root is the end of the chain of forms, found by pointer doubling. Counts at least double along a chain, so
it has no cycle and few steps.

Defined results: a null text has no words; a null id counts as an empty one; repeated rows count each;
words of equal counts are no forms of each other, and of equally frequent near words the smallest in
code-point order counts; an empty table gives no rows; a text of any length is read in slices between
words; columns beyond those named are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import UPPER, stored

_RUN = re.compile("[a-zÀ-ÿ]+")
_OTHER = re.compile("[^a-zÀ-ÿ]")
_LOWER = str.maketrans(UPPER, UPPER.lower())
#: Characters of a text that are read at once.
SLICE = 1 << 20
#: Different words that a task remembers before it hands their counts on.
REMEMBERED = 200_000


def runs_of(text: str) -> Iterator[list[str]]:
    """Letter runs of a text with A-Z lower-cased, in lists."""
    start = 0
    while start < len(text):
        stop = len(text)
        if stop - start > SLICE:
            border = _OTHER.search(text, start + SLICE)
            stop = border.start() if border else stop
        yield _RUN.findall(text[start:stop])
        start = stop


def _counter(least: int, every: int, schema: pa.Schema):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def handed_on() -> pa.RecordBatch:
            made = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(made, schema=schema)

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                before = (name.as_py() + ":").encode()
                text = text.as_py()
                if text is None:
                    continue
                start = crc32(before)
                for runs in runs_of(text.translate(_LOWER)):
                    for run, times in Counter(runs).items():
                        h = crc32(run.encode(), start) if every else 1
                        if every and h % every == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                        if len(run) >= least:
                            counts[run] = counts.get(run, 0) + times
                    if len(counts) > REMEMBERED:
                        yield handed_on()
        if counts:
            yield handed_on()

    return count


def count_words(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", least: int = 5, occurrences: int = 3, every: int = 0
) -> DataFrame:
    """``(word, n)``: letter runs of at least ``least`` characters that occur often enough.

    With ``every``, a run loses a character where the unsigned CRC-32 of ``<id>:<run>`` is a multiple of it.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    rows = documents.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(_counter(least, every, schema), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _key(length: Column, more: Column, a: Column, b: Column, word: Column, shift: Column) -> Column:
    """Hash of what a word keeps when the characters from ``a`` to ``b`` of the shorter one are open."""
    begin = F.substring(word, F.lit(1), a)
    return F.xxhash64(length, more, a, b, begin, F.substring(word, b + shift + 1, F.char_length(word)))


def _chunks(words: DataFrame) -> DataFrame:
    """``(word, length, more, a, b, place, key)`` of chunks; characters from ``a`` to ``b`` are outside the chunk."""
    half = F.floor(F.col("length") / 2).cast("int")
    cut = F.array(
        F.struct(half.alias("a"), F.col("length").alias("b"), F.lit(0).alias("place")),
        F.struct(F.lit(0).alias("a"), (F.col("length") - half).alias("b"), (F.col("length") - half).alias("place")),
    )
    rows = words.select("word", "length", half.alias("q"), F.explode(cut).alias("cut"))
    return rows.select("word", "length", F.explode(F.array(F.lit(0), F.lit(1))).alias("more"), "cut.*", "q").withColumn(
        "key", F.xxhash64("length", "more", "place", F.expr("substring(word, place + 1, q)"))
    )


def _grams(words: DataFrame) -> DataFrame:
    """The same columns of positional grams, for the chunks of words as long and of words shorter by one."""
    shorter = words.select("word", F.explode(F.array(F.lit(0), F.lit(1))).alias("more"), (F.col("length") - F.col("more")).alias("length"))
    half = F.floor(F.col("length") / 2).cast("int")
    last = F.col("length") - half
    place = F.array(
        F.struct(F.lit(0).alias("place"), half.alias("a"), F.col("length").alias("b")),
        F.struct(last.alias("place"), F.lit(0).alias("a"), last.alias("b")),
    )
    rows = shorter.where(F.col("length") > 0).select("word", "length", "more", half.alias("q"), F.explode(place).alias("at")).select("*", "at.*").drop("at")
    shifted = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("more"))).alias("shift"))
    return shifted.withColumn("key", F.xxhash64("length", "more", "place", F.expr("substring(word, place + shift + 1, q)")))


def _halved(rows: DataFrame, shifted: bool) -> DataFrame:
    """Each row twice, with either half of its open part demanded as well.

    A replaced character is at one of the open places, an inserted one before one of them or after the last.
    """
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    later = F.struct((middle + F.col("more")).alias("a"), F.col("b").alias("b"))
    either = F.array(later, F.struct(F.col("a").alias("a"), middle.alias("b")))
    shift = F.col("more") if shifted else F.lit(0)
    halves = rows.select("word", "length", "more", F.explode(either).alias("open")).select("word", "length", "more", "open.*")
    return halves.select("*", _key(F.col("length"), F.col("more"), F.col("a"), F.col("b"), F.col("word"), shift).alias("key"))


def near_pairs(words: DataFrame, *, common: int = 20_000) -> DataFrame:
    """``(a, b)``: pairs of words of ``words(word)`` that differ by exactly one edit, each once."""
    sized = words.select("word", F.char_length("word").alias("length")).where("length > 0")
    columns = ["word", "length", "more", "a", "b", "key"]
    chunks = stored(_chunks(sized).select(*columns), "chunks")
    grams = stored(_grams(sized).select(*columns), "grams")
    found = None
    while True:
        sides = chunks.groupBy("key").agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("m")).unionByName(
            grams.groupBy("key").agg(F.lit(0).cast("long").alias("n"), F.count("*").alias("m"))
        )
        least = F.when(F.col("more") == 0, 1).otherwise(0)
        many = stored(
            sides.groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
            .where(F.col("n").cast("double") * F.col("m") > common).select("key"), "common",
        )
        open_part = F.col("b") - F.col("a") > least
        few = (F.col("many").isNull()) | ~open_part
        marked = [side.join(many.select("key", F.lit(True).alias("many")), "key", "left") for side in (chunks, grams)]
        left, right = (side.where(few).select("key", F.col("word").alias(name)) for side, name in zip(marked, "ab"))
        pairs = left.join(right, "key").where((F.col("a") != F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
        pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "near")
        found = pairs if found is None else found.unionByName(pairs)
        rest = [side.where(~few).select(*columns) for side in marked]
        if many.isEmpty():
            return found.distinct()
        chunks = stored(_halved(rest[0], False), "chunks")
        # A shifted gram needs no halving: where the edit is before a chunk, the other chunk is whole too.
        grams = stored(_halved(rest[1], True).distinct(), "grams")


def variants(words: DataFrame, *, ratio: int = 2, common: int = 20_000) -> DataFrame:
    """``(word, n, form, root, n_near, form_n)`` for every row of ``words(word, n)``, which has each word once."""
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "words")
    pairs = stored(near_pairs(words, common=common), "pairs")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    )
    best_n = -F.col("best.order")
    chosen = best_n >= F.col("n") * ratio
    told = stored(
        words.join(best, "word", "left").select(
            "word", "n", F.when(chosen, F.col("best.near")).alias("form"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, best_n).alias("form_n"),
        ), "forms",
    )
    steps = stored(told.where("form is not null").select("word", F.col("form").alias("to")), "steps")
    while True:  # pointer doubling: a step becomes two
        ahead = steps.select(F.col("word").alias("to"), F.col("to").alias("further"))
        doubled = stored(steps.join(ahead, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "steps")
        steps = doubled.select("word", "to")
        if doubled.where("moved").isEmpty():
            break
    return told.join(steps, "word", "left").select(
        "word", "n", "form", F.coalesce("to", "word").alias("root"), "n_near", "form_n"
    )
