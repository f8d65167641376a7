"""SimHash near-dedup by tiled exact comparison.

Fingerprints come from XXH64 hashes of word shingles, one lane of 64 bits per seed. Distinct
fingerprints are dealt to cells by the population counts of their halves, and cells to tiles of a
bounded number of rows. Tiles with one population count in all make blocks, again of a bounded number of
rows. A task gets two blocks and compares them tile by tile, every row with every row, by exclusive-or and
bit counts in numpy, unless the population counts of two tiles differ by more than the radius, in which
case no pair can be within it. Blocks whose counts differ by more are not sent to one task at all.

So a row is sent as often as there are blocks within the radius, a fraction of rows / ``block``, and not
once for every tile. All comparisons together grow with the square of the number of distinct fingerprints,
as the method has it; tiles only spread and prune them.

A task returns a spanning forest of the links that it finds, at most one per row, so a group of near
copies never becomes all of its pairs, and no link between classes is lost. Connected components of
the forests are the groups. Documents with equal fingerprints enter as one row, named by their smallest id.

Defined results: a null or blank text has fingerprint zero and is linked like any other; fewer words
than a shingle are one shingle; repeated rows share one group; rows without an id get a fingerprint
and, if alone with it, no group; columns beyond those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import components, stored

SEED = 42
#: Tasks that pairs of blocks are dealt to at most.
MOST_TASKS = 20_000


def _shingles(text: str | None, width: int) -> list[bytes]:
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    return [joined[a:b] for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]


def fingerprint(text: str | None, width: int, lanes: int) -> np.ndarray:
    """``lanes`` unsigned numbers; a bit is set if it is set in over half of the shingle hashes."""
    shingles = _shingles(text, width)
    if not shingles:
        return np.zeros(lanes, np.uint64)
    digest = xxhash.xxh64_intdigest
    out = np.empty(lanes, np.uint64)
    for lane in range(lanes):
        seed = SEED + lane
        hashes = np.array([digest(shingle, seed) for shingle in shingles], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(shingles)
        out[lane] = np.packbits(majority, bitorder="little").view(np.uint64)[0]
    return out


def _maker(width: int, lanes: int, schema: pa.Schema):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(text.as_py(), width, lanes) for text in batch.column(1)]
            table = np.array(made, np.uint64).reshape(len(made), len(schema) - 1).view(np.int64)
            columns = [pa.array(np.ascontiguousarray(table[:, at])) for at in range(table.shape[1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    return make


def lane_names(lanes: int) -> list[str]:
    return [f"lane{number}" for number in range(lanes)]


def fingerprints(documents: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = 4, lanes: int = 1) -> DataFrame:
    """``(id, lane0, ..)`` for every document; lanes are signed longs with the fingerprint's bits."""
    names = lane_names(lanes)
    schema = pa.schema([("id", pa.int64()), *((name, pa.int64()) for name in names)])
    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_maker(width, lanes, schema), "id long, " + ", ".join(f"{name} long" for name in names))


def as_hex(lane: Column) -> Column:
    return F.lower(F.lpad(F.hex(lane), 16, "0"))


def _unite(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Joins the trees of linked nodes; labels stay roots, the smallest node of each tree."""
    while True:
        a, b = label[left], label[right]
        open = a != b
        if not open.any():
            return
        left, right, a, b = left[open], right[open], a[open], b[open]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            nearer = label[label]
            if np.array_equal(nearer, label):
                break
            label[:] = nearer


def _near(left: np.ndarray, right: np.ndarray, radius: int, size: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs within the radius; rows are of shape (rows, lanes)."""
    step = max(1, size // max(1, len(right)))
    columns = [np.ascontiguousarray(right[:, lane]) for lane in range(right.shape[1])]
    for start in range(0, len(left), step):
        rows = left[start : start + step]
        distance = np.bitwise_count(rows[:, 0][:, None] ^ columns[0])
        for lane in range(1, len(columns)):
            distance += np.bitwise_count(rows[:, lane][:, None] ^ columns[lane])
        near = np.flatnonzero(distance <= radius)
        if len(near):
            a, b = np.divmod(near, len(right))
            yield a + start, b


Tile = tuple[int, int, np.ndarray]


def forest(left: list[Tile], right: list[Tile] | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(row, row)`` that connect what pairs within the radius connect.

    A tile has the population counts of both halves and its rows. Rows are numbered through both lists;
    without ``right``, pairs are those inside ``left``.
    """
    tiles = left + (right or [])
    begins = np.concatenate(([0], np.cumsum([len(rows) for _, _, rows in tiles])))
    label = np.arange(begins[-1])
    for i, (c0, c1, rows) in enumerate(left):
        for j in range(i, len(left)) if right is None else range(len(left), len(tiles)):
            d0, d1, others = tiles[j]
            if abs(c0 - d0) + abs(c1 - d1) > radius:
                continue
            for a, b in _near(rows, others, radius):
                a, b = a + begins[i], b + begins[j]
                differ = a != b
                _unite(label, a[differ], b[differ])
    moved = np.flatnonzero(label != np.arange(len(label)))
    return moved, label[moved]


def _comparer(lanes: int, radius: int):
    """Tiles of a task come by pair of blocks, those of the first block before those of the second."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def found(sides: tuple[list, list]) -> Iterator[pa.RecordBatch]:
        left, right = ([(c0, c1, rows) for c0, c1, _, rows in side] for side in sides)
        names = [ids for side in sides for _, _, ids, _ in side]
        child, parent = forest(left, right or None, radius)
        if len(child):
            names = np.concatenate(names)
            yield pa.RecordBatch.from_arrays([pa.array(names[child]), pa.array(names[parent])], schema=schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, alone, sides = None, True, ([], [])
        for batch in batches:
            numbers, seconds, selves, c0, c1 = (batch.column(n).to_numpy(zero_copy_only=False) for n in range(5))
            ids, prints = batch.columns[5:]
            for row in range(batch.num_rows):
                if numbers[row] != at:
                    if sides[0] and (alone or sides[1]):
                        yield from found(sides)
                    at, alone, sides = numbers[row], bool(selves[row]), ([], [])
                table = prints[row].values.to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, lanes)
                name = ids[row].values.to_numpy(zero_copy_only=False)
                sides[seconds[row]].append((int(c0[row]), int(c1[row]), name, table))
        if sides[0] and (alone or sides[1]):
            yield from found(sides)

    return compare


def links(prints: DataFrame, *, lanes: int, radius: int, tile: int = 8192, block: int = 500_000) -> DataFrame:
    """Forest links ``(a, b)`` between the rows of ``(node, lane0, ..)``, whose fingerprints differ.

    A tile has at most about ``tile`` rows with the same population counts of either half of the
    fingerprint, a block at most about ``block`` rows with the same count in all (16 bytes a row and lane).
    """
    spark, names = prints.sparkSession, lane_names(lanes)
    if lanes == 1:
        counts = [F.bit_count(F.col("lane0").bitwiseAND(0xFFFFFFFF)), F.bit_count(F.shiftrightunsigned("lane0", 32))]
    else:
        counts = [sum(map(F.bit_count, names[: lanes // 2]), F.lit(0)), sum(map(F.bit_count, names[lanes // 2 :]), F.lit(0))]
    rows = prints.select("node", *names, *(count.cast("int").alias(f"c{k}") for k, count in enumerate(counts)))
    # At most one row per pair of population counts: small whatever the table.
    sizes = rows.groupBy("c0", "c1").agg(F.count("*").alias("n"))
    in_all: dict[int, int] = {}
    for row in sizes.groupBy((F.col("c0") + F.col("c1")).alias("c")).agg(F.sum("n").alias("n")).collect():
        in_all[row["c"]] = -(-row["n"] // block)
    if not in_all:
        return spark.createDataFrame([], "a long, b long")
    tiling = sizes.select("c0", "c1", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    rows = rows.join(F.broadcast(tiling), ["c0", "c1"]).withColumn("t", F.pmod(F.xxhash64(*names), F.col("tiles")).cast("int"))
    tiles = stored(
        rows.groupBy("c0", "c1", "t").agg(F.collect_list(F.struct("node", F.array(*names).alias("print"))).alias("rows"))
        .select("c0", "c1", "t", F.col("rows.node").alias("ids"), F.flatten("rows.print").alias("prints")),
        "tiles",
    )
    # Blocks u of count c meet blocks v of count d; pairs are numbered through all (c, d).
    meetings, pairs = [], 0
    for c, blocks in sorted(in_all.items()):
        for d in range(c, c + radius + 1):
            if d in in_all:
                meetings += [(c, d, False, blocks, in_all[d], pairs)] + ([(d, c, True, in_all[d], blocks, pairs)] if d > c else [])
                pairs += blocks * in_all[d]
    tasks = min(pairs, MOST_TASKS)
    meeting = spark.createDataFrame(meetings, "c int, d int, second boolean, own int, others int, first long")
    u = F.pmod(F.xxhash64("c0", "c1", "t"), F.col("own"))
    # Two bounded tables: at most (radius + 1) meetings of each population count.
    met = (
        tiles.withColumn("c", F.col("c0") + F.col("c1")).join(F.broadcast(meeting), "c").withColumn("u", u)
        .withColumn("v", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    )
    # Within one count a block is the first of a pair with itself and later ones, the second with earlier ones.
    same = F.col("c") == F.col("d")
    second = F.when(same, F.col("v") < F.col("u")).otherwise(F.col("second"))
    one, two, width = F.when(second, F.col("v")).otherwise(F.col("u")), F.when(second, F.col("u")).otherwise(F.col("v")), F.when(second, F.col("own")).otherwise(F.col("others"))
    dealt = met.select(
        (F.col("first") + one * width + two).alias("pair"), second.cast("int").alias("second"),
        (same & (F.col("u") == F.col("v"))).alias("alone"), "c0", "c1", "ids", "prints",
    )
    dealt = dealt.repartitionById(tasks, F.pmod("pair", F.lit(tasks)).cast("int")).sortWithinPartitions("pair", "second")
    return dealt.mapInArrow(_comparer(lanes, radius), "a long, b long")


def near_duplicates(
    documents: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    width: int = 4,
    lanes: int = 1,
    radius: int = 4,
    tile: int = 8192,
    block: int = 500_000,
) -> DataFrame:
    """Per document ``(id, lane0, .., component)``, the component named by its smallest id."""
    names = lane_names(lanes)
    prints = stored(fingerprints(documents, id=id, text=text, width=width, lanes=lanes), "fingerprints")
    classes = stored(prints.groupBy(*names).agg(F.min("id").alias("node")), "classes")
    found = links(classes.where(F.col("node").isNotNull()), lanes=lanes, radius=radius, tile=tile, block=block)
    roots = components(found)
    named = classes.join(roots, "node", "left").select(*names, F.coalesce("root", "node").alias("component"))
    return prints.join(named, names).select("id", *names, "component")
