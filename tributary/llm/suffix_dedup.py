"""Suffix-array dedup of repeated byte strings by prefix-free parsing.

Every byte is removed that is covered by a string of ``length`` bytes which also starts in a document
with a smaller id. Comparing all suffixes of a corpus is avoided by parsing it first:

1. *Triggers.* A hash runs over all words of ``WORD`` bytes; inside every string of ``length`` bytes
   the word with the smallest hash is its trigger. The content alone decides, so equal strings have
   their trigger at the same place.
2. *Phrases.* All neighbouring strings with the same trigger make one phrase, a piece of the text.
   Phrases overlap, and each string of ``length`` bytes lies in exactly one. A document is the list
   of its phrases, the parse; the different phrases are the dictionary.
3. *Parse.* Phrases are dealt by trigger and sorted by (trigger, phrase, document): an occurrence
   behind the first document of its phrase is repeated from end to end, whatever is inside.
4. *Dictionary.* Different phrases with the same trigger can still share strings. Only of these the
   bytes are fetched and their suffixes sorted to a depth of ``length``; neighbours in that order
   that agree so far are equal strings, and the smallest document among them has it first.

The corpus order of all strings is that of step 3 refined by step 4, as far as repeats need it. Within
a batch, copies of a phrase are settled at once, so a hot phrase leaves a batch once. Groups of a task
are processed in portions of bounded size.

Defined results: a null text is an empty one; a document shorter than ``length`` keeps all its bytes;
of equal texts the one with the smallest id stays; rows repeated whole are treated alike, and do not
repeat each other; rows without an id are kept whole and repeat nothing. Ids tell documents apart: two
texts under one id count as one document. Columns beyond those named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_fields, described, stored

#: Bytes in a trigger word.
WORD = 20
_M1, _M2, _M3 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_PLACE_BITS = np.uint64(32)

PHRASES = "part int, trigger array<int>, phrase array<bigint>, doc binary, start binary, run binary"
#: ``settled`` and ``open`` are places, see ``_place``; one of them is null.
SPANS = "doc bigint, settled bigint, open struct<place: bigint, key: bigint>"
#: Strings of one trigger that one task compares; those of a trigger with more are dealt by their own bytes.
HOT_STRINGS = 1 << 16


def _word_hashes(data: bytes, count: int) -> np.ndarray:
    """Hash of the ``WORD`` bytes from each of the first ``count`` places."""

    def eight(offset: int) -> np.ndarray:
        return np.ndarray((count,), "<u8", buffer=data, offset=offset, strides=(1,))

    value = eight(0) * _M1
    value ^= value >> np.uint64(29)
    value = (value ^ eight(8)) * _M2
    value ^= value >> np.uint64(31)
    value = (value ^ eight(WORD - 8)) * _M3
    value ^= value >> np.uint64(32)
    value *= _M1
    value ^= value >> np.uint64(29)
    return value


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return values if reach == width else np.minimum(values[: len(values) - (width - reach)], values[width - reach :])


def phrases(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text number, start, run, trigger hash, phrase hash) of all phrases.

    A phrase covers the strings of ``length`` bytes from ``start`` to ``start + run - 1``.
    """
    gap = bytes(length + 16)
    data = b"".join([part for text in texts for part in (text, gap)])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(sizes + len(gap))[:-1])) if len(texts) else np.zeros(0, np.int64)
    counts = np.maximum(sizes - length + 1, 0)
    total = int(counts.sum())
    if not total:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    hashes = _word_hashes(data, len(data) - WORD)
    places = np.arange(len(hashes), dtype=np.uint64)
    lowest = _window_minimum((hashes >> _PLACE_BITS << _PLACE_BITS) | places, length - WORD + 1)
    owner = np.repeat(np.arange(len(texts)), counts)
    before = np.concatenate(([0], np.cumsum(counts)[:-1]))
    strings = np.arange(total) - before[owner] + begins[owner]
    triggers = (lowest[strings] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    first = np.concatenate(([True], (np.diff(triggers) != 0) | (np.diff(owner) != 0)))
    at = np.flatnonzero(first)
    run = np.diff(np.concatenate((at, [total])))
    begin, digest = strings[at], xxhash.xxh64_intdigest
    made = np.array([digest(data[a:b]) for a, b in zip(begin.tolist(), (begin + run + length - 1).tolist())], np.uint64)
    return owner[at], begin - begins[owner[at]], run, hashes[triggers[at]], made


def _in_slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[tuple[list[int], list[bytes]]]:
    ids: list[int] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for id, text in zip(batch.column(0), batch.column(1)):
            data = (text.as_py() or "").encode("utf-8", "replace")
            if texts and size + len(data) > most:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(id.as_py())
            texts.append(data)
            size += len(data) + 128
    if texts:
        yield ids, texts


def _planes(values: np.ndarray) -> bytes:
    """The lowest bytes of all values, then the next ones: high bytes are alike and compress to nothing."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _parser(length: int, parts: int):
    schema = pa.schema(
        [
            ("part", pa.int32()), ("trigger", pa.list_(pa.int32())), ("phrase", pa.list_(pa.int64())),
            ("doc", pa.binary()), ("start", pa.binary()), ("run", pa.binary()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _in_slices(batches):
            owner, start, run, trigger, phrase = phrases(texts, length)
            if not len(owner):
                continue
            doc = np.array(ids, np.int64)[owner]
            order = np.lexsort((doc, phrase, trigger))
            trigger, phrase, doc, start, run = (v[order] for v in (trigger, phrase, doc, start, run))
            new = np.concatenate(([True], (np.diff(trigger) != 0) | (np.diff(phrase) != 0)))
            first = doc[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
            settled = doc > first
            part = (trigger % np.uint64(parts)).astype(np.int32)
            # Settled occurrences only pass through; their trigger is left out.
            part[settled] = (doc[settled] + start[settled]) % parts
            order = np.lexsort((settled, part))
            part, settled = part[order], settled[order]
            places = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)]))
            for side, keep in ((False, ~settled), (True, settled)):
                where = order[keep]
                offsets = np.concatenate(([0], np.cumsum(keep)))[places]
                none = np.zeros(len(places), np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(none if side and name in ("trigger", "phrase") else offsets.astype(np.int32)), pa.array(v))
                    for name, v in (
                        ("trigger", np.zeros(0, np.int32) if side else (trigger[where] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        ("phrase", np.zeros(0, np.int64) if side else phrase[where].view(np.int64)),
                    )
                ]
                cuts = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
                for values in (doc[where], start[where].astype(np.int32), run[where].astype(np.int16)):
                    lists.append(pa.array([_planes(values[a:b]) for a, b in cuts], pa.binary()))
                made = pa.RecordBatch.from_arrays([pa.array(part[places[:-1]], pa.int32()), *lists], schema=schema)
                sizes = np.diff(offsets)
                yield made if sizes.all() else made.filter(pa.array(sizes > 0))

    return parse


def _place(start, run, hot=0) -> np.ndarray:
    """Start and run of a span, and whether its trigger is hot, in one number: few bytes to shuffle."""
    return np.asarray(start, np.int64) << 17 | np.asarray(run, np.int64) << 1 | np.asarray(hot, np.int64)


def _parts_of(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 17, place >> 1 & 0xFFFF, (place & 1).astype(bool)


def _spans(doc, place, key=None) -> pa.RecordBatch:
    """Settled spans, or with the keys of their triggers open ones."""
    size, place = len(doc), pa.array(place, pa.int64())
    kind = pa.struct([("place", pa.int64()), ("key", pa.int64())])
    open = pa.nulls(size, kind) if key is None else pa.StructArray.from_arrays([place, pa.array(key, pa.int64())], fields=list(kind))
    settled = place if key is None else pa.nulls(size, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), settled, open], names=["doc", "settled", "open"])


def _flat(batch: pa.RecordBatch, number: int) -> np.ndarray:
    return batch.column(number).flatten().to_numpy(zero_copy_only=False)


def _sorter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated occurrences (not open), and occurrences whose strings must be compared (open)."""
    kept: list[list[np.ndarray]] = []
    for batch in batches:
        keyed = np.array([len(row) for row in batch.column(1)], np.int64)
        values = [
            np.concatenate([np.zeros(0, kind), *(_from_planes(data, kind) for data in batch.column(number).to_pylist())])
            for number, kind in ((3, np.int64), (4, np.int32), (5, np.int16))
        ]
        sizes = np.array([len(row.as_buffer()) // 8 for row in batch.column(3)], np.int64)
        passing = np.repeat(keyed == 0, sizes)
        if passing.any():
            doc, start, run = (v[passing] for v in values)
            yield _spans(doc, _place(start, run))
        part = np.repeat(batch.column(0).to_numpy(), keyed).astype(np.int64)
        key = part << 32 | _flat(batch, 1).view(np.uint32).astype(np.int64)
        kept.append([key, _flat(batch, 2), *(v[~passing] for v in values)])
    if not kept:
        return
    key, phrase, doc, start, run = (np.concatenate(column) for column in zip(*kept))
    kept.clear()
    order = np.lexsort((doc, phrase, key))
    key, phrase, doc, start, run = (v[order] for v in (key, phrase, doc, start, run))
    new_key = np.concatenate(([True], np.diff(key) != 0)) if len(key) else np.zeros(0, bool)
    new = new_key | np.concatenate(([True], np.diff(phrase) != 0)) if len(key) else new_key
    first = doc[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(key) else doc
    repeated = doc > first
    yield _spans(doc[repeated], _place(start[repeated], run[repeated]))
    group = np.cumsum(new_key) - 1
    several = (np.bincount(group, new) > 1)[group] if len(key) else new
    compare = several & ~repeated
    hot = np.bincount(group, run * compare)[group] > HOT_STRINGS if len(key) else compare
    yield _spans(doc[compare], _place(start[compare], run[compare], hot[compare]), key[compare])


def _columns_of(whole: bytes, place: np.ndarray, length: int) -> list[np.ndarray]:
    """The ``length`` bytes from each place as unsigned numbers, most telling ones first."""
    big = np.ndarray((len(whole) - 7,), ">u8", buffer=whole, strides=(1,))
    return [big[place + step].astype(np.uint64) for step in (*range(0, length - 8, 8), length - 8)]


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    mixed = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        mixed = (mixed ^ column) * _M1
        mixed ^= mixed >> np.uint64(31)
    return mixed


CUT = "key bigint, doc bigint, start int, run smallint, data binary"


def _single_strings(data: list[bytes], doc: np.ndarray, start: np.ndarray, run: np.ndarray, length: int) -> pa.RecordBatch:
    """Strings of hot triggers by themselves, dealt by their own bytes.

    Of equal strings that come together only one of the first document stays to be compared; the others
    are repeats already, and pass through without data.
    """
    whole = b"".join(data) + bytes(8)
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    owner = np.repeat(np.arange(len(data)), run)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(run) - run, run)
    place = (np.cumsum(sizes) - sizes)[owner] + offset
    columns = _columns_of(whole, place, length)
    key = _mixed(columns).view(np.int64)
    order = np.lexsort((doc[owner], *columns[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = np.any([column[order][1:] != column[order][:-1] for column in columns], axis=0)
    first = np.empty(len(order), np.int64)
    first[order] = doc[owner][order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    repeated = doc[owner] > first
    key = np.where(repeated, doc[owner] + start[owner] + offset, key)
    strings = [None if gone else whole[at : at + length] for gone, at in zip(repeated.tolist(), place.tolist())]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key), pa.array(doc[owner]), pa.array((start[owner] + offset).astype(np.int32)),
            pa.array(np.ones(len(owner), np.int16)), pa.array(strings, pa.binary()),
        ],
        names=["key", "doc", "start", "run", "data"],
    )


def _cutter(length: int):
    """Bytes of the phrases that must be compared, those of hot triggers as single strings."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                spans = rows.column(2)
                docs = np.repeat(rows.column(0).to_numpy(), spans.value_lengths().to_numpy())
                fields = spans.flatten()
                place, key = (fields.field(name).to_numpy(zero_copy_only=False) for name in ("place", "key"))
                start, run, hot = _parts_of(place)
                texts = [unpacked(data, codec) for data in rows.column(1).field(0).to_pylist()]
                owner = np.repeat(np.arange(rows.num_rows), spans.value_lengths().to_numpy())
                ends = start + run + length - 1
                data = [texts[o][a:b] for o, a, b in zip(owner.tolist(), start.tolist(), ends.tolist())]
                plain = ~hot
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[plain]), pa.array(docs[plain]), pa.array(start[plain].astype(np.int32)), pa.array(run[plain].astype(np.int16)),
                        pa.array([data[k] for k in np.flatnonzero(plain)], pa.binary()),
                    ],
                    names=["key", "doc", "start", "run", "data"],
                )
                if hot.any():
                    chosen = [data[k] for k in np.flatnonzero(hot)]
                    yield _single_strings(chosen, docs[hot], start[hot], run[hot], length)

    return cut


def first_documents(data: list[bytes], doc: np.ndarray, run: np.ndarray, length: int, chosen: int = 0, of: int = 1) -> tuple[np.ndarray, ...]:
    """Suffix order of phrases to a depth of ``length``: (phrase, offset, smallest document) of each string.

    With ``of`` above 1 only a share of the strings, chosen by content, is looked at.
    """
    whole = b"".join(data) + bytes(8)
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(data)), run)
    before = np.concatenate(([0], np.cumsum(run)[:-1]))
    offset = np.arange(len(owner)) - before[owner]
    place = begins[owner] + offset
    columns = _columns_of(whole, place, length)
    if of > 1:
        keep = _mixed(columns) % np.uint64(of) == chosen
        owner, offset, columns = owner[keep], offset[keep], [column[keep] for column in columns]
    order = np.lexsort(columns[::-1])
    differ = np.zeros(max(0, len(order) - 1), bool)
    for column in columns:
        column = column[order]
        differ |= column[1:] != column[:-1]
    owner, offset = owner[order], offset[order]
    begin = np.concatenate(([0], np.flatnonzero(differ) + 1)) if len(order) else np.zeros(0, np.int64)
    lowest = np.minimum.reduceat(doc[owner], begin) if len(order) else doc[:0]
    return owner, offset, np.repeat(lowest, np.diff(np.concatenate((begin, [len(order)]))))


def _comparer(length: int, most: int = 1 << 20):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = []
        for batch in batches:
            settled = batch.filter(batch.column(4).is_null())
            if settled.num_rows:
                doc, start, run = (settled.column(n).to_numpy() for n in (1, 2, 3))
                yield _spans(doc, _place(start, run))
            kept.append(batch.filter(batch.column(4).is_valid()))
        rows = pa.Table.from_batches(kept) if kept else None
        if rows is None or not rows.num_rows:
            return
        key = rows.column(0).to_numpy()
        order = np.argsort(key, kind="stable")
        key = key[order]
        doc, start, run = (rows.column(n).to_numpy()[order] for n in (1, 2, 3))
        run = run.astype(np.int64)
        data = rows.column(4)
        # Portions end where a trigger does; a trigger beyond the bound is taken in shares of its strings.
        ends = np.concatenate((np.flatnonzero(np.diff(key)) + 1, [len(key)]))
        upto = np.cumsum(run)
        at = 0
        while at < len(key):
            spent = upto[at - 1] if at else 0
            fits = ends[(ends > at) & (upto[ends - 1] - spent <= most)]
            end = int(fits[-1]) if len(fits) else int(ends[ends > at][0])
            shares = int(-(-(upto[end - 1] - spent) // most))
            part = slice(at, end)
            texts = data.take(pa.array(order[part])).to_pylist()
            for share in range(shares):
                owner, offset, lowest = first_documents(texts, doc[part], run[part], length, share, shares)
                repeated = doc[part][owner] > lowest
                owner, offset = owner[repeated], offset[repeated]
                yield _spans(doc[part][owner], _place(start[part][owner] + offset, np.ones(len(owner), np.int16)))
            at = end

    return compare


#: In front of bytes that are not compressed, in place of their length.
PLAIN = b"\xff" * 8


def packed(data: bytes, codec: pa.Codec) -> bytes:
    """Compressed, with its length in front: a shuffle's own compression leaves half as much again of a text."""
    return len(data).to_bytes(8, "little") + codec.compress(data, asbytes=True) if data else b""


def unpacked(data: bytes | None, codec: pa.Codec) -> bytes:
    if not data or data.startswith(PLAIN):
        return (data or b"")[8:]
    return codec.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd")
    for rows in (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256)):
        texts = [packed((text.as_py() or "").encode("utf-8", "replace"), codec) for text in rows.column(1)]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.binary()), *rows.columns[2:]], names=rows.schema.names)


def _given(documents: DataFrame, id: str, text: str, keep: tuple[str, ...]) -> DataFrame:
    kept = [F.col(name).alias(f"_{at}") for at, name in enumerate(keep, 1)]
    return documents.select(F.col(id).cast("long").alias("doc"), F.col(text).cast("string").alias("_0"), *kept)


def _plain() -> Column:
    return F.concat(F.lit(PLAIN), F.col("_0").cast("binary"))


def _row(rows: DataFrame) -> DataFrame:
    return rows.select("doc", F.struct(*rows.columns[1:]).alias("row"))


def _rows(documents: DataFrame, id: str, text: str, keep: tuple[str, ...]) -> DataFrame:
    """``(doc, row)`` of rows with an id, the packed text and what is kept in one struct.

    A text that is kept too is not packed: the shuffle's compression finds its second copy, but not next to a packed one.

    Both joins with the texts ask for the same two columns, so that Spark shuffles the texts once for both.
    """
    named = F.col("doc").isNotNull()
    given = _given(documents, id, text, keep).where(named)
    if text in keep:
        return _row(given.withColumn("_0", _plain()))
    kinds = [f"_{at} {documents.schema[name].dataType.simpleString()}" for at, name in enumerate(keep, 1)]
    # The condition again, behind the packing: a join adds it on one side, and the shuffles must be alike.
    return _row(given.mapInArrow(_packer, ", ".join(("doc bigint", "_0 binary", *kinds))).where(named))


def repeated_spans(
    documents: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    length: int = 50,
    bytes_per_task: int = 16 << 20,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc, spans)``: per document the repeated strings as structs ``(start, run)``.

    ``run`` strings of ``length`` bytes from byte ``start`` on are repeats.
    """
    found = _repeated(documents, _rows(documents, id, text, keep), id, text, length, bytes_per_task)
    span = "struct(cast(shiftright(place, 17) as int) as start, cast(shiftright(place, 1) & 65535 as smallint) as run)"
    return found.select("doc", F.expr(f"transform(spans, place -> {span})").alias("spans"))


def _repeated(documents: DataFrame, rows: DataFrame, id: str, text: str, length: int, bytes_per_task: int = 16 << 20) -> DataFrame:
    usable = documents.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text"))
    usable = usable.where(F.col("doc").isNotNull() & F.col("text").isNotNull())
    size = usable.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    tasks = max(documents.sparkSession.sparkContext.defaultParallelism, -(-size // bytes_per_task))
    parsed = usable.mapInArrow(_parser(length, 4 * tasks), PHRASES)
    found = parsed.repartition(tasks, "part").mapInArrow(_sorter, SPANS)
    by_doc = stored(found.groupBy("doc").agg(*(F.collect_list(name).alias(name) for name in ("settled", "open"))), "spans")
    cut = rows.join(by_doc.where(F.size("open") > 0), "doc").select("doc", "row", "open").mapInArrow(_cutter(length), CUT)
    compared = cut.repartition(tasks, "key").mapInArrow(_comparer(length), SPANS)
    again = compared.groupBy("doc").agg(F.collect_list("settled").alias("settled"))
    return (
        by_doc.select("doc", "settled")
        .unionByName(again)
        .groupBy("doc")
        .agg(F.flatten(F.collect_list("settled")).alias("spans"))
        .where(F.size("spans") > 0)
    )


def removed_bytes(size: int, starts: np.ndarray, runs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end places of the maximal removed stretches."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + runs + length - 1, size), -1)
    inside = np.concatenate(([False], np.cumsum(change[:-1]) > 0, [False]))
    edges = np.flatnonzero(np.diff(inside.astype(np.int8)))
    return edges[0::2], edges[1::2]


RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _remover(length: int, with_kept: bool, keep: tuple[str, ...], schema: pa.Schema):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            rows, texts = [], batch.column(1).field(0)
            others = [batch.column(1).field(at) for at in range(1, len(keep) + 1)]
            for at in range(batch.num_rows):
                data = unpacked(texts[at].as_py(), codec)
                spans = batch.column(2)[at]
                kept, removed, count = data, 0, 0
                if spans.is_valid and len(data) >= length:
                    starts, runs, _ = _parts_of(spans.values.to_numpy(zero_copy_only=False))
                    first, end = removed_bytes(len(data), starts, runs, length)
                    edges = [0, *np.stack((first, end), axis=1).ravel().tolist(), len(data)]
                    kept = b"".join([data[a:b] for a, b in zip(edges[0::2], edges[1::2])])
                    removed, count = len(data) - len(kept), len(first)
                rows.append((len(data), removed, count, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            made = [pa.array(list(values), kind) for values, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, *others], schema=schema)

    return remove


def remove_repeats(
    documents: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    length: int = 50,
    with_kept: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document ``(doc, n_bytes, n_removed, n_spans, kept_sha256, kept, *keep)``.

    ``kept`` holds the remaining bytes if ``with_kept`` asks for them; a cut may part a character.
    """
    rows = _rows(documents, id, text, keep)
    spans = _repeated(documents, rows, id, text, length)
    named = rows.join(spans, "doc", "left").select("doc", "row", "spans")
    others = _row(_given(documents, id, text, keep).where(F.col("doc").isNull()).withColumn("_0", _plain()))
    unnamed = others.select("doc", "row", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    schema = pa.schema(
        [
            ("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
            ("kept_sha256", pa.string()), ("kept", pa.binary()), *arrow_fields(documents, keep),
        ]
    )
    result = ", ".join(filter(None, ("doc bigint", RESULT, described(documents, keep))))
    return named.unionByName(unnamed).mapInArrow(_remover(length, with_kept, keep, schema), result)
