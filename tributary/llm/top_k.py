"""Exact top-k search by term-at-a-time accumulation over an inverted index of sparse vectors.

A vector is a row of terms and whole weights. Candidates are dealt evenly to blocks of a bounded number
of postings, and every query visits every block. A block keeps one posting list per term: the places of
its candidates and their weights. A query takes its terms one at a time and scatters each posting list,
times the weight of the term, into a dense array with one score per candidate. The k best scores of the
block are selected by partition, and those of all blocks are merged by Spark, which keeps at most k rows
a query and task before the shuffle.

The work is queries times postings, as an exhaustive search has it; the number of blocks follows the
postings, so a task holds one block, whatever the table, and streams the queries through it. Each query
row is sent once to each block, and nothing is broadcast.

Defined results: a candidate may share the id of the query only if it is the query's own row, so rows
with the query's id are left out. Equal scores are ranked by the smaller id; repeated candidates each
take a rank; repeated query rows of one id count as one, the one with the greatest terms and weights.
Rows with a null id, null terms or weights, or with a null among them, take no part. A vector without
terms scores zero against all. Terms repeated in a row add up. Weights are held within 2**27 either way,
so that no sum of up to 512 such products overflows. An empty table gives no rows. Columns beyond those
named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

LARGEST = 1 << 27
RESULT = "query_id long, vec_id long, score long"


def whole_weights(vector: Column, scale: int) -> tuple[Column, Column, Column]:
    """Terms and weights of a dense vector, zeros left out, and whether it takes part.

    A component x weighs ``floor(scale * x)``, with x as double. A vector that is null, or holds a null
    or a component that is not finite, takes no part.
    """
    entries = F.transform(
        vector, lambda x, at: F.struct(at.cast("int").alias("t"), F.floor(x.cast("double") * F.lit(scale)).cast("long").alias("w"))
    )
    filled = F.filter(entries, lambda e: e["w"] != 0)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.transform(filled, lambda e: e["t"]), F.transform(filled, lambda e: e["w"]), F.coalesce(finite, F.lit(False))


class Block:
    """Posting lists of some candidates, which are put in the order of their ids."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int32)
        place[order] = np.arange(len(ids), dtype=np.int32)
        self.ids = ids[order]
        docs = np.repeat(place, sizes)
        by_term = np.lexsort((docs, terms))
        terms, docs, weights = terms[by_term], docs[by_term], weights[by_term].astype(np.int64)
        # A term that a vector names twice becomes one posting, so that scattering never meets a place twice.
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (docs[1:] != docs[:-1])
        starts = np.flatnonzero(new)
        if len(starts) < len(terms):
            weights = np.add.reduceat(weights, starts)
            terms, docs = terms[starts], docs[starts]
        self.docs, self.weights = docs, weights
        bounds = np.flatnonzero(np.concatenate((np.ones(min(len(terms), 1), bool), terms[1:] != terms[:-1], np.ones(1, bool))))
        self.range = {int(terms[a]): (int(a), int(b)) for a, b in zip(bounds[:-1], bounds[1:])}
        self.scores = np.empty(len(ids), np.int64)
        self.product = np.empty(len(ids), np.int64)

    def search(self, query: int, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates of other ids, in no order."""
        scores = self.scores
        scores.fill(0)
        for term, weight in zip(terms.tolist(), weights.tolist()):
            a, b = self.range.get(term, (0, 0))
            if b - a == len(scores):  # every candidate has the term, in the order of the places
                np.multiply(self.weights[a:b], weight, out=self.product)
                np.add(scores, self.product, out=scores)
            elif b > a:
                scores[self.docs[a:b]] += self.weights[a:b] * weight
        first, last = (int(np.searchsorted(self.ids, query, side=side)) for side in ("left", "right"))
        if last == first:
            best = _best(scores, k)
        else:  # the query's own rows are cut out; places before and after keep the order of ids
            best = _best(np.concatenate((scores[:first], scores[last:])), k)
            best = np.where(best >= first, best + (last - first), best)
        return self.ids[best], scores[best]


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores; of equal ones the first places."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    level = np.flatnonzero(scores == least)[: k - len(above)]
    return np.concatenate((above, level))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return sizes, column.flatten().to_numpy(zero_copy_only=False)


def _searcher(k: int):
    """Rows of a task come by block, a block's candidates before its queries."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, gathered, block = None, [], None
        for batch in batches:
            numbers, asks = (batch.column(at).to_numpy(zero_copy_only=False) for at in (0, 1))
            edges = np.flatnonzero(np.concatenate(([True], (numbers[1:] != numbers[:-1]) | (asks[1:] != asks[:-1]), [True])))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if numbers[a] != number:
                    number, gathered, block = numbers[a], [], None
                part = batch.slice(a, b - a)
                ids = part.column(2).to_numpy(zero_copy_only=False)
                (sizes, terms), (_, weights) = _flat(part.column(3)), _flat(part.column(4))
                if not asks[a]:
                    gathered.append((ids, sizes, terms, weights))
                    continue
                if block is None and gathered:
                    block, gathered = Block(*(np.concatenate(x) for x in zip(*gathered))), []
                if block is None:
                    continue
                ends = np.cumsum(sizes)
                found = [block.search(int(q), terms[e - n : e], weights[e - n : e], k) for q, n, e in zip(ids, sizes, ends)]
                counts = [len(x) for x, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, counts)), *(pa.array(np.concatenate(x)) for x in zip(*found))], schema=schema
                )

    return search


def _usable(rows: DataFrame, id: str, terms: str, weights: str) -> DataFrame:
    whole = F.forall(terms, lambda t: t.isNotNull()) & F.forall(weights, lambda w: w.isNotNull())
    held = F.transform(F.col(weights).cast("array<long>"), lambda w: F.greatest(F.least(w, F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    return rows.where(F.col(id).isNotNull() & whole & (F.size(terms) == F.size(weights))).select(
        F.col(id).cast("long").alias("id"), F.col(terms).cast("array<int>").alias("terms"), held.alias("weights")
    )


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    *,
    k: int,
    id: str = "id",
    terms: str = "terms",
    weights: str = "weights",
    postings: int = 8_000_000,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k highest inner products with rows of other ids.

    ``postings`` bounds what a block holds (12 bytes each, some four times that while it is built).
    """
    spark = candidates.sparkSession
    all_rows = _usable(candidates, id, terms, weights)
    total = all_rows.agg(F.coalesce(F.sum(F.size("terms") + F.lit(1)), F.lit(0))).first()[0]
    blocks = max(spark.sparkContext.defaultParallelism, math.ceil(total / postings))
    # Dealt round robin and written: even blocks, whatever the ids, that a lost executor cannot change.
    dealt = stored(all_rows.repartition(blocks).withColumn("block", F.spark_partition_id()), "candidates")
    asked = _usable(queries, id, terms, weights).groupBy("id").agg(F.max(F.struct("terms", "weights")).alias("v"))
    visits = asked.select("id", "v.terms", "v.weights", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    names = ["block", "asks", "id", "terms", "weights"]
    rows = dealt.withColumn("asks", F.lit(False)).select(*names).union(visits.withColumn("asks", F.lit(True)).select(*names))
    found = (
        rows.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "asks").mapInArrow(_searcher(k), RESULT)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
