"""Quality by regularised quadratic discriminant analysis over statistics of the text.

Each class has a mean and a covariance that is shrunk twice: towards the pooled covariance, then
towards its diagonal. The score of a text is the logistic of the difference of the two
class log densities, computed from Mahalanobis distances with Cholesky factors that are made once.

The sums that means and covariances need are additive: every task sums its own labelled rows, Spark
adds the sums, and only those few numbers reach the driver. No label, language, source or id enters a
score.

Defined results: a null or blank text has statistics too (all counts zero) and is scored; labels that
are null are left out, of repeated ones the highest counts; without rows of both classes every score
is the share of good labels (one half without any); columns beyond those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

#: Order of the numbers in a row of statistics.
STATISTICS = (
    "words", "bytes_per_word", "upper", "digits", "symbols", "marks", "bars", "letters", "blank_ends",
    "distinct_words", "distinct_lines", "words_per_line", "sentence_ends", "longest_word",
)

_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SYMBOL = np.array([chr(b) in "#$%&*+<=>@^_~\\{}[]/" for b in range(256)])


def statistics(text: str | None) -> list[float]:
    """Transformed statistics: logarithms of counts, square roots of shares."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, n = max(1, len(data)), max(1, len(words))
    letters = int(counts[_LETTER].sum())
    return [
        np.log1p(len(words)),
        np.log1p(len(data) / n),
        np.sqrt(counts[_UPPER].sum() / max(1, letters)),
        np.sqrt(counts[_DIGIT].sum() / size),
        np.sqrt(counts[_SYMBOL].sum() / size),
        np.sqrt(counts[33] / size),
        np.sqrt(counts[124] / size),
        np.sqrt(letters / size),
        np.sqrt(counts[10] / size),
        np.sqrt(len(set(words)) / n),
        np.sqrt(len(set(lines)) / max(1, len(lines))),
        np.log1p(len(words) / max(1, len(lines))),
        np.sqrt(counts[46] / n),
        np.log1p(max(map(len, words), default=0)),
    ]


def measured(documents: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, x)``: the statistics of every whole text as an array of doubles."""
    rows = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statistics(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.float64()))], schema=schema)

    return rows.mapInArrow(run, f"id {kind.simpleString()}, x array<double>")


@dataclass
class Discriminant:
    """Prior log odds, and per class (0, 1) the mean and the Cholesky factor of its covariance.

    The inverses of the factors are made once, so that a batch costs one product a class.
    """

    prior: float
    means: list[np.ndarray]
    factors: list[np.ndarray]

    def __post_init__(self):
        self.inverses = [np.linalg.inv(factor) for factor in self.factors]

    def scores(self, x: np.ndarray) -> np.ndarray:
        odds = np.full(len(x), self.prior)
        for sign, mean, factor, inverse in zip((-1, 1), self.means, self.factors, self.inverses):
            whitened = inverse @ (x - mean).T
            odds += sign * -0.5 * ((whitened**2).sum(axis=0) + 2 * np.log(np.diag(factor)).sum())
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -40, 40)))


def class_sums(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label the number of rows ``(x, label)``, the sum of x and the sum of its outer products."""
    width = len(STATISTICS)
    schema = pa.schema([("label", pa.int32()), ("at", pa.int32()), ("value", pa.float64())])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(-1, width)
                label = batch.column(1).to_numpy()
                for value in (0, 1):
                    own = x[label == value]
                    sums[value] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        size = sums.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], size), pa.int32()), pa.array(np.tile(np.arange(size), 2), pa.int32()), pa.array(sums.ravel())],
            schema=schema,
        )

    parts = rows.select("x", "label").mapInArrow(partial, "label int, at int, value double")
    totals = np.zeros((2, 1 + width + width * width))
    for label, at, value in parts.groupBy("label", "at").agg(F.sum("value").alias("value")).collect():
        totals[label, at] = value
    return {
        label: (own[0], own[1 : 1 + width], own[1 + width :].reshape(width, width)) for label, own in enumerate(totals)
    }


def fit(rows: DataFrame, *, to_pooled: float = 0.1, to_diagonal: float = 0.02) -> Discriminant | float:
    """The discriminant of rows ``(x, label)``, or the share of label 1 if a class is absent."""
    sums = class_sums(rows)
    total = sums[0][0] + sums[1][0]
    if not (sums[0][0] and sums[1][0]):
        return sums[1][0] / total if total else 0.5
    means = [total_x / count for count, total_x, _ in (sums[0], sums[1])]
    scatter = [outer - count * np.outer(mean, mean) for (count, _, outer), mean in zip((sums[0], sums[1]), means)]
    pooled = (scatter[0] + scatter[1]) / total
    spread = np.diag(np.maximum(np.diag(pooled), 1e-9))
    factors = []
    for (count, _, _), own in zip((sums[0], sums[1]), scatter):
        shrunk = (1 - to_pooled) * own / count + to_pooled * pooled
        factors.append(np.linalg.cholesky((1 - to_diagonal) * shrunk + to_diagonal * spread))
    return Discriminant(float(np.log(sums[1][0] / sums[0][0])), means, factors)


def score(measures: DataFrame, model: Discriminant | float) -> DataFrame:
    """``(id, score)`` for rows ``(id, x)``."""
    kind = measures.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("score", pa.float64())])
    width = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if isinstance(model, float):
                values = np.full(batch.num_rows, model)
            else:
                values = model.scores(batch.column(1).flatten().to_numpy().reshape(-1, width))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], schema=schema)

    return measures.select("id", "x").mapInArrow(run, f"id {kind.simpleString()}, score double")


def classify(
    documents: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    training: Column,
) -> DataFrame:
    """``(id, score)`` for every document; ``training`` says of an ``id`` whether its label may be learnt."""
    measures = stored(measured(documents, id=id, text=text), "statistics")
    marks = (
        labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & training)
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    return score(measures, fit(measures.join(marks, "id")))
