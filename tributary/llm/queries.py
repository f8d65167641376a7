"""One query per operator, over the whole table it is meant for, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import fill_in_middle as fim, licences, quality, simhash, spelling, sql, top_k, toxicity
from .common import load
from .decontamination import decontaminate
from .fingerprints import edited_fingerprints
from .pieces import Model, encode
from .sharding import shard
from .suffix_dedup import remove_repeats
from .url_filters import judge

#: A public model file; a parameter of the operators.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    """Registers a query under its name, and its SQL from ``sql.py`` if there is any."""
    name = function.__name__
    QUERIES[name] = function
    if hasattr(sql, name.upper()):
        ORACLES[name] = getattr(sql, name.upper())
    return function


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"), width=4, lanes=1, radius=4)
    return found.select(
        F.col("id").alias("doc_id"), simhash.as_hex(F.col("lane0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    model = toxicity.fit(documents, load(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).withColumnRenamed("id", "doc_id")


@query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(load(spark, sf_dir, "documents"), length=50).select(
        F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@query
def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: those that end in a licence statement stand for licence files, at three depths."""
    documents = load(spark, sf_dir, "documents")
    shelf = [F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.floor(F.col("doc_id") / 32).cast("string")]
    ends_in_licence = F.coalesce(F.col("text").rlike(r"(?i)licen[cs]ed?[^\n]*\s*$"), F.lit(False))
    depth = F.when(ends_in_licence, 1 + F.pmod("doc_id", F.lit(3))).otherwise(F.lit(3)).cast("int")
    name = F.concat(F.when(ends_in_licence, "LICENSE-").otherwise("text-"), F.col("doc_id").cast("string"))
    path = F.concat_ws("/", F.array_join(F.slice(F.array(*shelf), F.lit(1), depth), "/"), name)
    found = licences.scan(documents.select(path.alias("path"), "text"))
    return found.withColumn("doc_id", F.regexp_extract("path", "-([0-9]+)$", 1).cast("long"))


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(load(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(load(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(load(spark, sf_dir, "pages")).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("id").cast("string")) % 4 == 2, F.lit(False))
    scores = quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), training=~held_out)
    return scores.select(
        F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return hits.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether decoding them gives its text back."""
    model = Model(PIECE_MODEL)
    encoded = encode(load(spark, sf_dir, "documents"), model, verify=True)
    return encoded.select(
        F.col("id").alias("doc_id"),
        F.size("tokens").cast("long").alias("n_tokens"),
        F.col("tokens").alias("token_ids"),
        F.col("exact").alias("round_trip"),
    )


@query
def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms, weights, whole = top_k.whole_weights(F.col("embedding"), 256)
    vectors = load(spark, sf_dir, "embeddings").where(whole).select(
        F.col("vec_id").alias("id"), terms.alias("terms"), weights.alias("weights")
    )
    return top_k.top_k(vectors.where(F.col("id") % 50 == 0), vectors, k=5)


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(load(spark, sf_dir, "documents"), least=5, occurrences=3, every=97)
    return spelling.variants(words, ratio=2)


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(load(spark, sf_dir, "documents"), seed=7, rate=100, suffix_first=50)
    return made.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
