"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text and their first letters (``PREFIXES``), which also catch
inflected and compound forms. One weight per feature is shared by all ordered thresholds:
P(grade <= k) = logistic(threshold_k - weights * features). The expected severity is the sum over k
of P(grade > k).

The model is fitted on a bounded sample of labelled rows (``sample_rows`` per value of the label),
chosen by a hash of the id and weighted back to the counts of all labelled rows; everything is scored.

Defined results: a null or wordless text has no features and gets the severity of the thresholds
alone; labels that are null, or of unknown documents, are left out, and of repeated ones the highest
counts; without labels of both kinds every severity is zero; columns beyond those named are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_fields, described
from .decontamination import words_of

PREFIXES = (4, 5, 6, 7)
_MEMORY = 300_000


def features_of(word: bytes) -> list[bytes]:
    """The word, closed by a blank, and its first letters if it is longer."""
    return [word + b" ", *(word[:n] for n in PREFIXES if len(word) >= n)]


def logistic(value):
    return 1.0 / (1.0 + np.exp(-np.clip(value, -40.0, 40.0)))


@dataclass
class OrdinalModel:
    """Weights by feature and the increasing thresholds between grades."""

    weights: dict[bytes, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def margin(self, words: set[bytes], memory: dict[bytes, tuple[bytes, ...]]) -> float:
        found: set[bytes] = set()
        for word in words:
            hits = memory.get(word)
            if hits is None:
                hits = tuple(f for f in features_of(word) if f in self.weights)
                if len(memory) < _MEMORY:
                    memory[word] = hits
            if hits:
                found.update(hits)
        return float(sum(self.weights[f] for f in sorted(found)))

    def above(self, margin: float) -> list[float]:
        """P(grade > k) for each threshold."""
        return [float(1.0 - logistic(t - margin)) for t in self.thresholds]


def fit_ordinal(
    rows: list[list[int]], grades: np.ndarray, weight: np.ndarray, width: int, *, ridge: float = 1e-3, steps: int = 400
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model, by Adam on the penalised likelihood.

    ``rows`` are lists of present features. Thresholds are a first one and positive gaps, so that they
    stay ordered.
    """
    top = int(grades.max())
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter((f for row in rows for f in row), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(rows)), sizes)
    share = weight / weight.sum()
    below = np.array([share[grades <= k].sum() for k in range(top)])
    start = np.log(np.clip(below, 1e-6, 1 - 1e-6) / np.clip(1 - below, 1e-6, 1))
    state = np.concatenate((np.zeros(width), start[:1], np.log(np.maximum(np.diff(start), 1e-3))))
    mean, square = np.zeros_like(state), np.zeros_like(state)
    at = np.arange(len(rows))
    for step in range(1, steps + 1):
        weights, gaps = state[:width], np.exp(state[width + 1 :])
        cuts = np.concatenate(([-np.inf], state[width] + np.concatenate(([0.0], np.cumsum(gaps))), [np.inf]))
        margin = np.bincount(owner, weights[flat], len(rows))
        upper, lower = logistic(cuts[grades + 1] - margin), logistic(cuts[grades] - margin)
        chance = np.maximum(upper - lower, 1e-12)
        slope_up, slope_low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_margin = share * (slope_up - slope_low)
        by_cut = np.zeros(top + 2)
        np.add.at(by_cut, grades[at] + 1, -share * slope_up)
        np.add.at(by_cut, grades[at], share * slope_low)
        by_cut = by_cut[1:-1]
        tail = np.cumsum(by_cut[::-1])[::-1]  # each gap moves all later thresholds
        slope = np.concatenate(
            (np.bincount(flat, by_margin[owner], width) + ridge * weights, tail[:1], tail[1:] * gaps)
        )
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        rate = 0.1 * (1 - 0.9 * step / steps)
        state = state - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return state[:width], state[width] + np.concatenate(([0.0], np.cumsum(np.exp(state[width + 1 :]))))


def features_in(text: str | None) -> set[bytes]:
    return {feature for word in set(words_of(text)) for feature in features_of(word)}


def telling_features(texts: list[str | None], positive: np.ndarray, *, least: float, most: int) -> dict[bytes, float]:
    """Features whose presence depends on the label: signed chi-square, the strongest ``most``."""
    with_label, without = Counter(), Counter()
    for text, is_positive in zip(texts, positive):
        (with_label if is_positive else without).update(features_in(text))
    n1, n0 = int(positive.sum()), int((~positive).sum())
    scored = {}
    for feature in with_label.keys() | without.keys():
        a, b = with_label[feature], without[feature]
        if a + b < 5:
            continue
        c, d = n1 - a, n0 - b
        gap = a * d - b * c
        value = (n1 + n0) * gap * gap / max(1.0, float(a + b) * (c + d) * n1 * n0)
        if value >= least:
            scored[feature] = value if gap > 0 else -value
    return dict(sorted(scored.items(), key=lambda item: (-abs(item[1]), item[0]))[:most])


def labelled_sample(
    documents: DataFrame, labels: DataFrame, *, id: str, text: str, label: str, sample_rows: int
) -> tuple[list[tuple[str | None, int]], dict[int, int]]:
    """Up to ``sample_rows`` texts per value of the label, and the counts of all labelled rows."""
    marks = (
        labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    counts = {row["label"]: row["count"] for row in marks.groupBy("label").count().collect()}
    grain = 1_000_000
    share = F.when(F.col("label") == 1, F.lit(int(grain * sample_rows / max(1, counts.get(1, 1))))).otherwise(
        F.lit(int(grain * sample_rows / max(1, counts.get(0, 1))))
    )
    # Bounded by sample_rows in expectation, and by the limit whatever the ids.
    chosen = marks.where(F.pmod(F.xxhash64("id"), F.lit(grain)) < share).limit(4 * sample_rows)
    texts = documents.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    return [(row["text"], row["label"]) for row in texts.select("text", "label").toLocalIterator()], counts


def grades_of(found: list[set[bytes]], positive: np.ndarray, telling: dict[bytes, float]) -> np.ndarray:
    """Severity grades of labelled texts: 0 for clean ones; toxic ones are graded 1 to 3 by how many
    different telling words they use, against the median and the upper quartile of that number."""
    strong = {f for f, value in telling.items() if value > 0 and f.endswith(b" ")}
    used = np.array([len(features & strong) for features in found])
    grades = np.zeros(len(found), np.int64)
    marks = np.quantile(used[positive], [0.5, 0.75])
    grades[positive] = 1 + (used[positive, None] > marks).sum(axis=1)
    # Grades without members would leave a threshold undetermined.
    return np.searchsorted(np.unique(grades), grades)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: int = 3000,
    least_chi_square: float = 30.0,
    most_features: int = 4000,
    ridge: float = 1e-4,
) -> OrdinalModel:
    sample, counts = labelled_sample(documents, labels, id=id, text=text, label=label, sample_rows=sample_rows)
    positive = np.array([mark == 1 for _, mark in sample], bool)
    if not positive.any() or positive.all():
        return OrdinalModel()
    texts = [text for text, _ in sample]
    telling = telling_features(texts, positive, least=least_chi_square, most=most_features)
    found = [features_in(text) & telling.keys() for text in texts]
    grades = grades_of(found, positive, telling)
    numbers = {feature: number for number, feature in enumerate(telling)}
    rows = [sorted(numbers[f] for f in features) for features in found]
    weight = np.where(positive, counts[1] / positive.sum(), counts[0] / (~positive).sum())
    weights, thresholds = fit_ordinal(rows, grades, weight, len(numbers), ridge=ridge)
    return OrdinalModel({f: float(weights[n]) for f, n in numbers.items()}, [float(t) for t in thresholds])


def score(
    documents: DataFrame,
    model: OrdinalModel,
    *,
    id: str = "doc_id",
    text: str = "text",
    reject: float = 0.5,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, severity, p_toxic, grade, toxic, *keep)``: expected severity, P(grade > 0), likeliest grade, verdict."""
    rows = documents.select(F.col(id).alias("id"), F.col(text).alias("_text"), *keep)
    schema = pa.schema(
        [
            *arrow_fields(rows, ("id",)), ("severity", pa.float64()), ("p_toxic", pa.float64()), ("grade", pa.int32()),
            ("toxic", pa.bool_()), *arrow_fields(rows, keep),
        ]
    )
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[bytes, tuple[bytes, ...]] = {}
        for batch in batches:
            out = []
            for value in batch.column(1):
                above = shared.value.above(shared.value.margin(set(words_of(value.as_py())), memory))
                steps = np.array([1.0, *above, 0.0])
                chance = float(above[0]) if above else 0.0
                out.append((float(sum(above)), chance, int(np.argmax(steps[:-1] - steps[1:])), chance >= reject))
            columns = list(zip(*out)) if out else [()] * 4
            made = [pa.array(list(v), t) for v, t in zip(columns, schema.types[1:5])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, *batch.columns[2:]], schema=schema)

    result = f"{described(rows, ('id',))}, severity double, p_toxic double, grade int, toxic boolean"
    return rows.mapInArrow(run, ", ".join(filter(None, (result, described(rows, keep)))))
