"""Sharding by minimax contiguous partition of atomic groups.

Documents with equal texts form one group that is never cut. Groups stand in the order of their
smallest id, and every shard takes a contiguous run of them. The capacity, the size of the largest
shard, is the smallest one for which the greedy fill needs no more shards than there are. The greedy fill
leaves all slack to the last shards, so the cuts are then moved within the capacity: of the ends of groups
next to even cuts, those that make the smallest shard as large as possible are taken.

The search runs on a stored table of running totals. One aggregate answers a step of the greedy fill
for many capacities at once; when the rows that can still decide are few, they are finished exactly
on the driver. Beyond ``few`` rows the search simply goes on in Spark, so the bound loses nothing.

Defined results: a null text is an empty one (size ``overhead``); an empty table gives no rows; rows
repeated whole keep one slot each; columns beyond those named are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import numbered, stored


def _below(limits: list[int], value: Column) -> Column:
    """How many of the limits are smaller than the value."""
    return F.size(F.filter(F.lit(limits), lambda limit: limit < value))


def _reach(totals: DataFrame, limits: list[int], largest: int) -> dict[int, int]:
    """For each limit the largest running total that does not exceed it."""
    ordered = sorted(set(limits))
    near = totals.where(F.col("upto").between(ordered[0] - largest, ordered[-1]))
    found = near.groupBy(_below(ordered, F.col("upto")).alias("at")).agg(F.max("upto").alias("top")).collect()
    tops = {row["at"]: row["top"] for row in found}
    reached, top = {}, 0
    for at, limit in enumerate(ordered):
        top = max(top, tops.get(at, 0))
        reached[limit] = top
    return reached


def _fill(totals: DataFrame, capacities: list[int], shards: int, total: int, largest: int) -> dict[int, list[int]]:
    """The cuts of the greedy fill for each capacity; feasible if the last one is the total."""
    cuts: dict[int, list[int]] = {capacity: [] for capacity in capacities}
    at = dict.fromkeys(capacities, 0)
    for _ in range(shards):
        limits = {c: at[c] + c for c in capacities}
        asked = [limit for limit in limits.values() if limit < total]
        reached = _reach(totals, asked, largest) if asked else {}
        for c, limit in limits.items():
            at[c] = total if limit >= total else reached[limit]
            cuts[c].append(at[c])
    return cuts


def _fill_here(upto: list[int], capacity: int, shards: int) -> list[int]:
    cuts, at = [], 0
    for _ in range(shards):
        place = bisect_right(upto, at + capacity)
        at = upto[place - 1] if place else at
        cuts.append(at)
    return cuts


def smallest_cuts(totals: DataFrame, shards: int, *, candidates: int = 64, few: int = 200_000) -> list[int]:
    """Running totals at which shards end, for the smallest feasible capacity."""
    facts = totals.agg(F.max("upto").alias("total"), F.max("size").alias("largest")).first()
    total, largest = facts["total"], facts["largest"]
    if total is None:
        return []
    low = max(largest, -(-total // shards))  # no capacity below this one can do
    high = -(-total // shards) + largest  # this one always does
    first = _fill(totals, sorted({low, high}), shards, total, largest)
    if first[low][-1] == total:
        return first[low]
    lower, upper = first[low], first[high]
    while high - low > 1:
        # A greedy cut never moves back when the capacity grows: only these stretches can matter.
        spans = [(a, b) for a, b in zip(lower, upper)]
        inside = F.lit(False)
        for a, b in spans:
            inside = inside | F.col("upto").between(a, b)
        rows = totals.where(inside).select("upto").limit(few + 1).collect()
        if len(rows) <= few:
            upto = sorted({row["upto"] for row in rows})
            while high - low > 1:
                middle = (low + high) // 2
                cuts = _fill_here(upto, middle, shards)
                if cuts[-1] == total:
                    high, upper = middle, cuts
                else:
                    low = middle
            return upper
        step = max(1, (high - low) // (candidates + 1))
        tried = list(range(low + step, high, step))[:candidates]
        fills = _fill(totals, tried, shards, total, largest)
        for capacity in tried:
            if fills[capacity][-1] == total:
                high, upper = capacity, fills[capacity]
                break
            low, lower = capacity, fills[capacity]
    return upper


def _even_places(totals: DataFrame, shards: int, total: int) -> list[int]:
    """Where even cuts would be. A group above the even share fills a shard, and the rest is shared anew."""
    giants: list = []
    while True:
        rest, parts = total - sum(g["size"] for g in giants), shards - len(giants)
        if rest <= 0 or parts <= 0:
            break
        # Fewer than there are shards: each is above the mean of what is left.
        more = totals.where(F.col("size") * parts > rest).select("size", "upto").collect()
        if len(more) == len(giants):
            break
        giants = more
    places = {end for g in giants for end in (g["upto"] - g["size"], g["upto"])}
    for number in range(1, max(1, parts)):
        place = rest * number // parts
        for g in sorted(giants, key=lambda giant: giant["upto"]):
            if g["upto"] - g["size"] <= place:
                place += g["size"]
        places.add(place)
    return sorted(places)


def _closest_ends(totals: DataFrame, places: list[int], nearest: int) -> set[int]:
    """The ends of groups closest to the places on either side."""
    stretch = _below(places, F.col("upto"))
    found: set[int] = set()
    for order in (F.desc("upto"), F.asc("upto")):
        window = Window.partitionBy("stretch").orderBy(order)
        ranked = totals.select("upto", stretch.alias("stretch")).withColumn("rank", F.row_number().over(window))
        found |= {row["upto"] for row in ranked.where(F.col("rank") <= nearest).collect()}
    return found


def largest_floor(ends: np.ndarray, shards: int, capacity: int) -> list[int]:
    """Cuts out of ``ends`` (ascending, the last one is the total) with the largest smallest shard."""
    points = np.concatenate(([0], ends))
    size = points[None, :] - points[:, None]
    allowed = (size >= 0) & (size <= capacity)
    floor = np.where(points == 0, points[-1], -1)
    chosen = []
    for _ in range(shards):
        value = np.where(allowed, np.minimum(floor[:, None], size), -1)
        chosen.append(value.argmax(axis=0))
        floor = value.max(axis=0)
    at, cuts = len(points) - 1, []
    for before in reversed(chosen):
        cuts.append(int(points[at]))
        at = before[at]
    return cuts[::-1]


def even_cuts(totals: DataFrame, shards: int, cuts: list[int], *, nearest: int = 32) -> list[int]:
    """The cuts of the greedy fill moved next to even ones, without a shard beyond the largest it has.

    The driver chooses among at most ``2 * nearest`` ends next to each even place. The greedy cuts are
    among them, so there is always a choice.
    """
    if not cuts:
        return cuts
    total, capacity = cuts[-1], max(b - a for a, b in zip([0, *cuts], cuts))
    places = _even_places(totals, shards, total)
    ends = _closest_ends(totals, places, nearest) if places else set()
    return largest_floor(np.array(sorted(ends | set(cuts)), np.int64), shards, capacity)


def shard(
    documents: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    shards: int = 24,
    overhead: int = 8,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Per document ``(id, size, text_crc32, shard, slot)``; slots count from 0 in every shard."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = stored(
        documents.select(
            F.col(id).alias("id"),
            (F.octet_length(whole) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(whole).alias("text_crc32"),
            F.unhex(F.sha2(whole, 256)).alias("group"),
        ),
        "sizes",
    )
    context = documents.sparkSession.sparkContext
    tasks = max(context.defaultParallelism, -(-rows.count() // rows_per_task))
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.min("id").alias("first"))
    totals = stored(numbered(groups, ["first", "group"], {"upto": "size"}, tasks), "totals")
    cuts = even_cuts(totals, shards, smallest_cuts(totals, shards))
    placed = totals.select("group", "first", _below(cuts or [0], F.col("upto")).alias("shard"))
    ranked = stored(
        numbered(
            rows.join(placed, "group").withColumn("one", F.lit(1).cast("long")),
            ["first", "group", "id"], {"place": "one"}, tasks,
        ),
        "ranked",
    )
    starts = {row["shard"]: row["start"] for row in ranked.groupBy("shard").agg(F.min("place").alias("start")).collect()}
    offsets = F.array(*(F.lit(starts.get(number, 0)).cast("long") for number in range(shards)))
    return ranked.select(
        "id", "size", "text_crc32", "shard", (F.col("place") - F.get(offsets, F.col("shard"))).alias("slot")
    )
