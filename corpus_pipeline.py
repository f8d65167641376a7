"""Documents to training tokens: five stages, each one operator of ``tributary.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept. All
but the last return the columns of documents. Rows with null or empty texts pass through every stage
(as one group of near copies they leave one of them); rows without an id are never dropped as copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.llm import simhash, toxicity as severity
from tributary.llm.common import load, stored
from tributary.llm.decontamination import decontaminate
from tributary.llm.pieces import Model, encode
from tributary.llm.queries import PIECE_MODEL
from tributary.llm.suffix_dedup import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go."""
    model = severity.fit(docs, load(spark, sf_dir, "labels"))
    return severity.score(docs, model, keep=COLUMNS).where(~F.col("toxic")).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Near copies are linked by fingerprints of four-word shingles that differ in at most 4 of 64 bits.
    """
    found = simhash.near_duplicates(docs, width=4, lanes=1, radius=4)
    copies = found.where(F.col("id") != F.col("component")).select(F.col("id").alias("doc_id"))
    return docs.join(copies, "doc_id", "left_anti").select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stretches of 50 bytes and more that an earlier document has are cut out of the texts."""
    cut = remove_repeats(docs, length=50, with_kept=True, keep=COLUMNS)
    kept = F.col("kept").cast("string")
    # A cut may part a character; what is left of one goes too.
    whole = F.coalesce(F.try_validate_utf8(kept), F.regexp_replace(F.make_valid_utf8(kept), "\uFFFD", ""))
    cut = cut.withColumn("text", F.when(F.col("n_removed") > 0, whole).otherwise(F.col("text")))
    return cut.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a stretch of ten words of a benchmark item, or a whole shorter item, go."""
    hits = decontaminate(docs, load(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return hits.where(F.col("n_hit") == 0).select(*COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers of the texts, and whether decoding them gives the text back."""
    tokens = encode(docs, Model(PIECE_MODEL), verify=True, keep=("lang", "source"))
    return tokens.select(
        F.col("id").alias("doc_id"),
        "lang",
        "source",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.col("tokens").alias("token_ids"),
        F.col("exact").alias("round_trip"),
    )


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: Near copies, the model and the pieces are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, name)
    return docs
