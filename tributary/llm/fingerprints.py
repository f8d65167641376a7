"""Document fingerprints by threshold-scaled sketches.

A sketch holds every distinct shingle hash below a fraction of the hash range, and the fraction itself. It
is an eighth for long texts; a text with fewer than ``LEAST`` hashes below it gets twice, four or eight
times that, all hashes in the end, so that short texts have whole sketches. Every sketch is complete below
its own bound, so sketches of very unequal documents are compared below the smaller of two bounds, and the
sketch of several documents together is the union of theirs below the smallest one.

Likeness is the share of the own sketch's hashes that the other document has below the own bound. Where
both texts are at hand the other one is sketched with the own fraction, so that a short text inside a long
one is found whole; :func:`containment` does what two stored sketches allow.

Defined results: a null text is an empty one; a text without words has an empty sketch; two empty
sketches are alike (1), an empty and a filled one are not (0); a text of fewer words than a shingle is
one shingle; columns beyond those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ASCII_BLANKS, ascii_lower, stored


def shingle_hashes(text: Column, width: int) -> Column:
    words = F.filter(F.split(ascii_lower(text), ASCII_BLANKS), lambda word: word != "")
    return F.transform(
        F.array(words),
        lambda own: F.when(F.size(own) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(own) - F.lit(width - 1), F.lit(1))),
                lambda at: F.xxhash64(F.concat_ws(" ", F.slice(own, at, F.lit(width)))),
            )
        ),
    )[0]


#: A sketch holds at least so many hashes, unless the text has fewer.
LEAST = 256
#: Halvings of the range at most: an eighth.
HALVINGS = 3


def bound_of(halvings: Column) -> Column:
    """Hashes below this are kept; the largest hash of all is not told apart from the bound of all."""
    kept = F.lit(None).cast("long")
    for number in range(HALVINGS + 1):
        kept = F.when(halvings == number, F.lit(min(2**63 - 1, -(2**63) + (2**64 >> number)))).otherwise(kept)
    return kept


def distinct_hashes(text: Column, width: int = 5) -> Column:
    return F.array_distinct(shingle_hashes(text, width))


def halvings_of(hashes: Column, least: int = LEAST) -> Column:
    """How often the range is halved for a text with these distinct hashes."""
    found = F.lit(0)
    for number in range(1, HALVINGS + 1):
        found = F.when(F.size(hashes) >= F.lit(least << number), number).otherwise(found)
    return found


def below(hashes: Column, halvings: Column) -> Column:
    """The hashes that a sketch with this fraction holds, sorted. Only these are sorted, never all of a text."""
    kept = F.transform(F.array(bound_of(halvings)), lambda bound: F.filter(hashes, lambda hash: (hash < bound) | (halvings == 0)))
    return F.array_sort(kept[0])


def sketch(text: Column, *, width: int = 5, least: int = LEAST) -> Column:
    """``struct(halvings, hashes)`` of a text, the hashes sorted."""
    hashes = F.array(distinct_hashes(text, width))
    return F.transform(
        hashes,
        lambda own: F.struct(halvings_of(own, least).alias("halvings"), below(own, halvings_of(own, least)).alias("hashes")),
    )[0]


def as_text(halvings: Column, hashes: Column) -> Column:
    """The number of halvings, a colon, and the hashes as 16 hexadecimal digits each."""
    return F.concat(halvings.cast("string"), F.lit(":"), F.concat_ws("", F.transform(hashes, lambda hash: F.lower(F.lpad(F.hex(hash), 16, "0")))))


def share_of(own: Column, other: Column) -> Column:
    """Share of hashes that are among other ones; 1 for two empty sides, 0 if only the first is empty."""
    shared = F.size(F.array_intersect(own, other)).cast("double")
    return F.when(F.size(own) > 0, shared / F.size(own)).otherwise(F.when(F.size(other) > 0, 0.0).otherwise(1.0))


def containment(own: Column, other: Column) -> Column:
    """Estimated share of the first text's shingles that the second has too, from two sketches.

    Only hashes below both bounds count; null where the first sketch has hashes, but none of them there.
    """
    halvings = F.greatest(own["halvings"], other["halvings"])
    near, far = below(own["hashes"], halvings), below(other["hashes"], halvings)
    return F.when((F.size(near) == 0) & (F.size(own["hashes"]) > 0), F.lit(None)).otherwise(share_of(near, far))


def merged(sketches: DataFrame, by: list[str], column: str = "sketch") -> DataFrame:
    """Sketches of groups of documents, below the smallest bound of a group.

    Hashes are made distinct per group before and after the shuffle.
    """
    bounds = sketches.groupBy(*by).agg(F.max(F.col(column)["halvings"]).alias("halvings"))
    hashes = sketches.select(*by, F.explode(F.col(column)["hashes"]).alias("hash")).distinct()
    kept = hashes.join(bounds, by).where((F.col("hash") < bound_of(F.col("halvings"))) | (F.col("halvings") == 0))
    gathered = kept.groupBy(*by).agg(F.array_sort(F.collect_list("hash")).alias("hashes"))
    whole = bounds.join(gathered, by, "left")
    return whole.select(*by, F.struct("halvings", F.coalesce("hashes", F.array().cast("array<bigint>")).alias("hashes")).alias(column))


def _blocks_after(names: DataFrame) -> DataFrame:
    """``(block, above)``: each block with the next higher one, the highest with the lowest.

    Sorted in ranges; only the lowest block of each range meets the others in one task.
    """
    parts = max(1, names.sparkSession.sparkContext.defaultParallelism)
    ranged = stored(names.repartitionByRange(parts, "block").withColumn("part", F.spark_partition_id()), "blocks")
    lowest = ranged.groupBy("part").agg(F.min("block").alias("low"))
    all_parts = Window.orderBy("part")
    following = lowest.select("part", F.coalesce(F.lead("low").over(all_parts), F.min("low").over(Window.partitionBy())).alias("following"))
    within = F.lead("block").over(Window.partitionBy("part").orderBy("block"))
    return ranged.withColumn("inside", within).join(following, "part").select("block", F.coalesce("inside", "following").alias("above"))


def with_next(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", bytes_per_block: int = 4 << 20, width: int = 5
) -> DataFrame:
    """Each document next to its follower in descending order of ids, the first one after the last.

    Returns ``(id, text, hashes, next_text, next_hashes)``, with all distinct hashes. Documents are dealt to blocks of
    neighbouring ids, each with a copy of the first document of the block that follows; texts are
    shuffled once and no block grows with the table.
    """
    rows = documents.select(
        F.col(id).cast("long").alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    facts = rows.agg(F.min("id"), F.max("id"), F.sum(F.octet_length("text").cast("long")), F.count("*")).first()
    low, high = facts[0] or 0, facts[1] or 0
    ids = _block_width(rows, low, high, max(1, (facts[2] or 0) // bytes_per_block), facts[3])
    # Documents without an id come last and share a block of their own.
    block = F.coalesce(F.floor((F.col("id") - F.lit(low)) / F.lit(ids)).cast("long"), F.lit(-1))
    rows = rows.withColumn("block", block)
    heads = rows.groupBy("block").agg(
        F.max_by(F.struct("id", "text", "mark"), F.struct("id", "mark")).alias("head")
    )
    above = _blocks_after(rows.select("block").distinct())
    copies = heads.join(above, "block").select("head.*", F.col("above").alias("block"), F.lit(True).alias("copy"))
    dealt = rows.select("id", "text", "mark", "block", F.lit(False).alias("copy")).unionByName(copies)
    dealt = dealt.repartition("block").withColumn("hashes", distinct_hashes(F.col("text"), width))
    order = Window.partitionBy("block").orderBy(
        F.col("copy"), F.col("id").desc_nulls_last(), F.col("mark").desc()
    )
    return (
        dealt.withColumn("next", F.lead(F.struct("text", "hashes")).over(order))
        .where(~F.col("copy"))
        .select("id", "text", "hashes", F.col("next.text").alias("next_text"), F.col("next.hashes").alias("next_hashes"))
    )


def _block_width(rows: DataFrame, low: int, high: int, blocks: int, count: int) -> int:
    """Ids per block, narrowed while a crowded stretch of ids fills a block far beyond the mean."""
    width = max(1, -(-(high - low + 1) // blocks))
    while width > 1:
        crowd = rows.groupBy(F.floor((F.col("id") - F.lit(low)) / F.lit(width))).count().agg(F.max("count")).first()[0]
        if (crowd or 0) <= 4 * max(1, count // blocks):
            break
        width = max(1, width // 8)
    return width


def edited_fingerprints(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", bytes_per_block: int = 4 << 20, width: int = 5, least: int = LEAST
) -> DataFrame:
    """Fingerprints of texts and of their edited forms, with the likeness to the edit and to the follower.

    The edit replaces the last third of the code points by the first ones of the next document.
    """
    pairs = with_next(documents, id=id, text=text, bytes_per_block=bytes_per_block, width=width)
    length = F.char_length("text")
    third = F.floor(length / 3).cast("int")
    edited = F.concat(F.left("text", length - third), F.left("next_text", third))
    told = pairs.select("id", length.cast("long").alias("n_chars"), "hashes", "next_hashes", edited.alias("edited"))
    told = told.withColumn("edited_hashes", distinct_hashes(F.col("edited"), width))
    told = told.withColumns({"halvings": halvings_of(F.col("hashes"), least), "edited_halvings": halvings_of(F.col("edited_hashes"), least)})
    told = told.withColumns(
        {"sketch": below(F.col("hashes"), F.col("halvings")), "edited_sketch": below(F.col("edited_hashes"), F.col("edited_halvings"))}
    )
    return told.select(
        "id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("halvings"), F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_halvings"), F.col("edited_sketch")).alias("edited_fingerprint"),
        # The other texts are sketched with the own fraction: of them only hashes below the own bound can be met.
        share_of(F.col("sketch"), F.col("edited_hashes")).alias("near_edited"),
        share_of(F.col("sketch"), F.col("next_hashes")).alias("near_next"),
    )
