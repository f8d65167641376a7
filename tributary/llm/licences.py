"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor.

Every line of a file is compared with the licence templates, and the whole text too if the file's
name says that it is a licence file. Inverse document frequencies of all terms are counted over all
files; those of terms outside the templates are joined to the few lines that are compared.
A line can reach the threshold for a template only if it holds one of the template's telling terms
(the heaviest ones, chosen such that all others together stay below the threshold), so only such
lines are compared, and none is lost.

A file without a licence of its own inherits the one of the nearest directory above it that has a
licence file. Directories are resolved first, by joins on their paths; files then join their own.

Templates are a list of bounded size; everything that depends on files stays in Spark.

Defined results: a null or empty text has no licence of its own; a null path has no directory and
inherits nothing; of equally close templates the first by name wins, of several licence files in a
directory the closest one, then the first by path; repeated rows get equal results; without files the
result is empty. Columns beyond those named are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from re import findall

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, stored

#: Statements by which a file or a licence file names its licence. Fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying)[^/]*$"


def terms_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), "[^a-z0-9]+"), lambda term: term != "")


def _terms_here(text: str) -> Counter:
    return Counter(findall("[a-z0-9]+", text.lower()))


def inverse_frequency(files: int, having: int) -> float:
    return math.log((1 + files) / (1 + having)) + 1


def template_weights(templates: list[tuple[str, str]], idf: dict[str, float]) -> list[dict[str, float]]:
    """Unit vectors of the templates."""
    vectors = []
    for _, text in templates:
        weights = {term: count * idf[term] for term, count in _terms_here(text).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        vectors.append({term: w / norm for term, w in weights.items()})
    return vectors


def telling_terms(vectors: list[dict[str, float]], threshold: float) -> list[str]:
    """Terms of which every line that reaches the threshold must have one."""
    telling: set[str] = set()
    for vector in vectors:
        rest = 1.0
        for term, weight in sorted(vector.items(), key=lambda item: (-item[1], item[0])):
            if rest < threshold**2 * (1 - 1e-9):
                break
            telling.add(term)
            rest -= weight**2
    return sorted(telling)


def parent(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), "")


def scan(
    files: DataFrame,
    *,
    path: str = "path",
    text: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.6,
    licence_file: str = LICENCE_FILE,
) -> DataFrame:
    """Per file ``(path, licence, cosine, basis, origin)``.

    ``basis`` is "own", "inherited" or "none"; ``origin`` is the path of the file that names the licence.
    """
    spark = files.sparkSession
    rows = files.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    vocabulary = sorted({term for _, statement in templates for term in _terms_here(statement)})
    # Each term once per file, summed in the tasks before the shuffle.
    having = rows.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"))
    having = stored(having.groupBy("term").agg(F.count("*").alias("having")), "terms")
    counts = {row["term"]: row["having"] for row in having.where(F.col("term").isin(vocabulary)).collect()}
    total = rows.count()
    idf = {term: inverse_frequency(total, counts.get(term, 0)) for term in vocabulary}
    vectors = template_weights(templates, idf)
    weights = spark.createDataFrame(
        [
            (number, name, term, idf[term], float(weight))
            for number, ((name, _), vector) in enumerate(zip(templates, vectors))
            for term, weight in vector.items()
        ],
        "template int, name string, term string, idf double, weight double",
    )

    named = F.col("path").rlike(licence_file)
    blocks = F.concat(
        F.split("text", "\n"), F.when(named, F.array("text")).otherwise(F.array().cast("array<string>"))
    )
    lines = rows.where(F.col("path").isNotNull()).select("path", F.posexplode(blocks).alias("line", "block"))
    lines = lines.select("path", "line", terms_of(F.col("block")).alias("terms")).where(
        F.arrays_overlap("terms", F.lit(telling_terms(vectors, threshold)))
    )
    # Few lines hold a telling term; they are found by one pass over the texts.
    counted = stored(
        lines.distinct()
        .select("path", "line", F.explode("terms").alias("term"))
        .groupBy("path", "line", "term")
        .agg(F.count("*").alias("tf")),
        "lines",
    )
    scale = F.log(F.lit(float(1 + total)) / (1 + F.col("having"))) + 1
    used = having.join(counted.select("term").distinct(), "term").select("term", scale.alias("idf"))
    norms = counted.join(used, "term").groupBy("path", "line").agg(F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("norm"))
    dots = counted.join(F.broadcast(weights), "term").groupBy("path", "line", "template", "name").agg(
        F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot")
    )
    close = dots.join(norms, ["path", "line"]).select(
        "path", "name", F.round(F.col("dot") / F.col("norm"), 4).alias("cosine")
    )
    own = (
        close.where(F.col("cosine") >= threshold)
        .groupBy("path")
        .agg(F.min(F.struct((-F.col("cosine")).alias("far"), "name")).alias("best"))
        .select("path", F.col("best.name").alias("licence"), (-F.col("best.far")).alias("cosine"))
    )
    owners = own.where(named).select(parent(F.col("path")).alias("above"), "path", "licence", "cosine")
    holders = owners.groupBy("above").agg(
        F.min(F.struct((-F.col("cosine")).alias("far"), F.col("path").alias("origin"), "licence")).alias("held")
    )
    placed = rows.select("path", parent(F.col("path")).alias("directory"))
    parts = F.split("directory", "/")
    steps = (
        placed.select("directory").where(F.col("directory").isNotNull()).distinct()
        .select("directory", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"))
        .select("directory", "depth", F.array_join(F.slice(parts, 1, F.col("depth")), "/").alias("above"))
    )
    nearest = steps.join(holders, "above").groupBy("directory").agg(F.max_by("held", "depth").alias("held"))
    return (
        placed.join(own, "path", "left")
        .join(nearest, "directory", "left")
        .select(
            "path",
            F.coalesce("licence", "held.licence").alias("licence"),
            F.coalesce("cosine", -F.col("held.far")).alias("cosine"),
            F.when(F.col("licence").isNotNull(), "own").when(F.col("held").isNotNull(), "inherited").otherwise("none").alias("basis"),
            F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("held.origin")).alias("origin"),
        )
    )
