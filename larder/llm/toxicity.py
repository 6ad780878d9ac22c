"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words, word pairs and pairs with one word left out are present or absent in a text. Each coordinate has its own
learning rate, and the L1 term keeps the weight of what does not tell the classes apart at exactly zero, so the
model is a short list of features and weights that is broadcast for scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashed
from .blocks import text_blocks
from .tables import documents


@dataclass(frozen=True)
class FtrlSpec:
    rate: float = 2.0  # alpha
    smooth: float = 1.0  # beta
    l1: float = 1.0
    l2: float = 0.1
    epochs: int = 10
    shards: int = 4
    least_rows: int = 4  # training rows that a feature must occur in
    most_rows: int = 8000  # training rows of each class: the bound of the sample


@dataclass(frozen=True)
class SparseModel:
    """Logistic model with a weight for some features; every other weight is zero."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def ftrl(spec: FtrlSpec) -> hashed.Learn:
    """One pass of FTRL-proximal over a shard; the state is (z, n), the last coordinate of which is the bias."""

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        active = np.maximum(np.abs(z) - spec.l1, 0)
        return -np.sign(z) * active / ((spec.smooth + np.sqrt(n)) / spec.rate + spec.l2)

    def learn(state: list[np.ndarray], found: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
        z, n = state
        bias = len(z) - 1
        for at, label in zip(found, labels, strict=True):
            at = np.append(at, bias)
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            w[-1] = -zs[-1] / ((spec.smooth + np.sqrt(ns[-1])) / spec.rate)  # the bias is not regularised
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / spec.rate * w
            n[at] = ns + g * g
        return [z, n]

    return learn


def fit(docs: DataFrame, labelled: DataFrame, spec: FtrlSpec = FtrlSpec()) -> SparseModel:
    """Fits ``labelled(doc_id, label)``, label 0 or 1, to the texts of ``docs(doc_id, text)``.

    At most about ``most_rows`` rows of each label are used. Without any row every text scores 0.5.
    """
    sample = hashed.sampled(labelled, "label", spec.most_rows)
    rows = hashed.training_rows(docs, sample, hashed.grams, spec.shards)
    known = hashed.vocabulary(rows, spec.least_rows)
    shards = hashed.shard_rows(rows, known)
    z, n = hashed.mixed_epochs(shards, [np.zeros(len(known) + 1), np.zeros(len(known) + 1)], ftrl(spec), spec.epochs)
    scale = (spec.smooth + np.sqrt(n)) / spec.rate
    weights = -np.sign(z) * np.maximum(np.abs(z) - spec.l1, 0) / (scale + spec.l2)
    kept = np.flatnonzero(weights[:-1])
    return SparseModel(known[kept], weights[kept], float(-z[-1] / scale[-1]))


def score(docs: DataFrame, model: SparseModel, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs(doc_id, text)``; an empty text scores by the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, block in text_blocks(batch.column(1)):
                rows, found = hashed.grams(block)
                at, there = hashed.lookup(model.features, found)
                hits = np.unique((rows[there].astype(np.int64) << 32) | at[there])  # present or absent
                total = model.bias + np.bincount(hits >> 32, model.weights[hits & 0xFFFFFFFF], len(block))
                scores = pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(block)), scores], schema=schema)

    scored = docs.select("doc_id", "text").mapInArrow(work, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity(
    docs: DataFrame, labels: DataFrame, learn_from, spec: FtrlSpec = FtrlSpec(), threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fits on the labelled rows for which ``learn_from`` (a condition on ``doc_id``) holds, and scores every row.

    ``labels(doc_id, toxic)``: a document is toxic if one of its label rows says so; null labels and ids are
    ignored. Returns ``doc_id, score, predicted`` for every row, null texts as empty ones.
    """
    texts = documents(docs, id_col, text_col)
    known = labels.filter("doc_id is not null and toxic in (0, 1)").filter(learn_from)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    return score(texts, fit(texts, known, spec), threshold)
