"""Quality by ordinal regression: a cumulative-link model over hashed text features.

Grades are ordered. One weight vector w serves all of them; grade k or better has probability
``sigmoid(w.x - threshold[k])`` with increasing thresholds. The expected grade is the sum of these tail
probabilities, and selection asks for a tail probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashed
from .blocks import Block, text_blocks
from .tables import documents


@dataclass(frozen=True)
class OrdinalSpec:
    grades: int = 3
    rate: float = 0.5
    l2: float = 1e-5
    epochs: int = 8
    shards: int = 4
    least_rows: int = 5  # training rows that a feature must occur in
    most_rows: int = 6000  # training rows of each grade: the bound of the sample


@dataclass(frozen=True)
class OrdinalModel:
    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray  # of grade 1 or better, grade 2 or better, ...


def graded(labels: DataFrame) -> DataFrame:
    """Grades from ratings: 0 poor, 1 good but toxic, 2 good; ``doc_id, label``, the lowest where rows disagree."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    rated = labels.filter("doc_id is not null and quality in (0, 1)")
    return rated.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade).alias("label"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def values(counts: np.ndarray, total: float) -> np.ndarray:
    """Square roots of a text's feature shares: a vector of length one, whatever the length of the text."""
    return np.sqrt(counts / total)


def thresholds(first: float, steps: np.ndarray) -> np.ndarray:
    return np.concatenate([[first], first + np.cumsum(np.exp(steps))])


def link_gradient(s: float, cuts: np.ndarray, grade: int) -> tuple[float, np.ndarray]:
    """Gradient of the negative log-likelihood of one text by its score s and by the thresholds."""
    tail = sigmoid(s - cuts)
    upper = 1.0 if grade == 0 else tail[grade - 1]
    lower = 0.0 if grade == len(cuts) else tail[grade]
    p = max(upper - lower, 1e-9)
    by_cut = np.zeros(len(cuts))
    if grade > 0:
        by_cut[grade - 1] = upper * (1 - upper) / p
    if grade < len(cuts):
        by_cut[grade] = -lower * (1 - lower) / p
    return -float(by_cut.sum()), by_cut


def adagrad(spec: OrdinalSpec) -> hashed.Learn:
    """One pass over a shard. State: parameters and summed squared gradients; the thresholds are the last ones."""
    steps = spec.grades - 1

    def learn(state: list[np.ndarray], found: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
        w, squares = state
        own = np.arange(len(w) - steps, len(w))
        for at, n, grade in zip(found, counts, labels, strict=True):
            x = values(n[:-1], n[-1]) if n[-1] else np.empty(0)
            at = at[:-1]
            cuts = thresholds(w[own[0]], w[own[1:]])
            by_score, by_cut = link_gradient(float(w[at] @ x), cuts, int(grade))
            g = by_score * x + spec.l2 * w[at]
            squares[at] += g * g
            w[at] -= spec.rate * g / np.sqrt(squares[at] + 1e-8)
            inner = np.cumsum(by_cut[::-1])[::-1]  # a threshold moves all later ones along
            g = np.concatenate([[inner[0]], inner[1:] * np.exp(w[own[1:]])])
            squares[own] += g * g
            w[own] -= spec.rate * g / np.sqrt(squares[own] + 1e-8)
        return [w, squares]

    return learn


def _with_totals(rows: DataFrame) -> DataFrame:
    """Ends ``counts`` with the number of all features of the text, known or not, and ``found`` with a 0 beside it."""
    total = F.aggregate("counts", F.lit(0), lambda a, b: a + b)
    return rows.withColumns({"found": F.concat("found", F.array(F.lit(-1))), "counts": F.concat("counts", F.array(total))})


def fit(docs: DataFrame, labelled: DataFrame, spec: OrdinalSpec = OrdinalSpec()) -> OrdinalModel:
    """Fits ``labelled(doc_id, label)``, labels 0 to ``grades - 1``, to the texts of ``docs(doc_id, text)``."""
    sample = hashed.sampled(labelled, "label", spec.most_rows)
    rows = _with_totals(hashed.training_rows(docs, sample, hashed.style, spec.shards))
    known = hashed.vocabulary(rows, spec.least_rows)
    known = np.concatenate([[-1], known[known >= 0]]).astype(np.int32)  # -1 carries the totals along
    shards = hashed.shard_rows(rows, known)
    width = len(known)
    start = np.zeros(width + spec.grades - 1)
    w, _ = hashed.mixed_epochs(shards, [start, start.copy()], adagrad(spec), spec.epochs)
    return OrdinalModel(known[1:], w[1:width], thresholds(w[width], w[width + 1 :]))


def block_tails(block: Block, model: OrdinalModel) -> np.ndarray:
    """For each text of a block the probabilities of grade 1 or better, grade 2 or better, ..."""
    rows, found = hashed.style(block)
    total = np.maximum(np.bincount(rows, minlength=len(block)), 1)
    at, there = hashed.lookup(model.features, found)
    keys, counts = np.unique((rows[there].astype(np.int64) << 32) | at[there], return_counts=True)
    row = keys >> 32
    scores = np.bincount(row, values(counts, total[row]) * model.weights[keys & 0xFFFFFFFF], len(block))
    return sigmoid(scores[:, None] - model.thresholds)


def kept_rows(docs: DataFrame, model: OrdinalModel, least: int = 1, tail: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, with all their columns; decided where they are, none is moved.

    A null text counts as empty: it has no feature. Equal texts are judged alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, block in text_blocks(batch.column(place)):
                good = block_tails(block, shared.value)[:, least - 1] >= tail
                yield batch.slice(first, len(block)).filter(pa.array(good))

    return docs.mapInArrow(work, docs.schema)


def score(docs: DataFrame, model: OrdinalModel, least: int = 1, tail: float = 0.5) -> DataFrame:
    """``doc_id, expected_grade, tails, kept`` for every row of ``docs(doc_id, text)``.

    ``tails[k]`` is the probability of grade k + 1 or better; a row is kept if that of grade ``least`` reaches
    ``tail``. A text without any feature has score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("tails", pa.list_(pa.float64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, block in text_blocks(batch.column(1)):
                tails = block_tails(block, shared.value)
                lists = pa.array(list(tails), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(block)), pa.array(tails.sum(1)), lists], schema=schema
                )

    scored = docs.select("doc_id", "text").mapInArrow(work, "doc_id long, expected_grade double, tails array<double>")
    return scored.withColumn("kept", F.col("tails")[least - 1] >= tail)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column | None = None,
    spec: OrdinalSpec = OrdinalSpec(),
    least: int = 1,
    tail: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fits on the graded rows (those for which ``learn_from`` holds) and scores every row; see ``score``.

    Without a single graded row all scores and thresholds are 0 or above and nothing is told apart: every row
    has the same tails. Null texts count as empty.
    """
    texts = documents(docs, id_col, text_col)
    known = graded(labels)
    return score(texts, fit(texts, known.filter(learn_from) if learn_from is not None else known, spec), least, tail)
