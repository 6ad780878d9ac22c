"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, a function of the letter and a seed alone. An n-gram is the
product of its letters' vectors, each permuted (rolled) by its place; a text is the sum of its n-grams, a
language the sum of its texts. The language whose profile has the largest cosine with the text is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import Block, mix, text_blocks
from .tables import documents

EDGE = 0  # stands for every run of characters between words
ROWS = 128  # texts whose n-gram counts are multiplied at a time
UNKNOWN = "und"


@dataclass(frozen=True)
class ProfileSpec:
    size: int = 2048  # components of a vector
    gram: int = 3
    most_rows: int = 4000  # training texts of each language: the bound of the sample
    most_languages: int = 1000  # the most frequent ones are learned: the bound of the profiles, 8 MB
    seed: int = 4


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def letter_vectors(letters: np.ndarray, spec: ProfileSpec) -> np.ndarray:
    """One row of +1 and -1 for each code point."""
    words = -(-spec.size // 64)
    with np.errstate(over="ignore"):
        start = letters.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(spec.seed)
        bits = mix(mix(start) + np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    signs = np.unpackbits(bits.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, : spec.size]
    return (signs.astype(np.int8) * 2 - 1).astype(np.int8)


def gram_vectors(grams: np.ndarray, spec: ProfileSpec) -> np.ndarray:
    """Bound vectors of n-grams (rows of code points): the letters' vectors, rolled by their place, multiplied."""
    letters, at = np.unique(grams, return_inverse=True)
    table = letter_vectors(letters, spec)
    at = at.reshape(grams.shape)
    out = np.ones((len(grams), spec.size), np.int8)
    for place in range(spec.gram):
        out *= np.roll(table, spec.gram - 1 - place, axis=1)[at[:, place]]
    return out


def text_grams(block: Block, spec: ProfileSpec) -> tuple[np.ndarray, np.ndarray]:
    """Row and code points of every n-gram: words of lower-cased letters, with an edge before and after each."""
    rows_of, codes = [], []
    for row in range(len(block)):
        text = np.frombuffer(block.raw(row).decode().lower().encode("utf-32-le"), np.uint32)
        letters = np.where(letter_table()[text], text, EDGE)
        keep = np.ones(len(letters), bool)
        keep[1:] = (letters[1:] != EDGE) | (letters[:-1] != EDGE)
        if letters.any():
            codes += [[EDGE], letters[keep], [EDGE]]
            rows_of.append(np.full(int(keep.sum()) + 2, row))
    if not codes:
        return np.empty(0, np.int64), np.empty((0, spec.gram), np.uint32)
    line, rows = np.concatenate(codes).astype(np.uint32), np.concatenate(rows_of)
    # An edge doubled at a text's begin or end makes no n-gram of its own.
    double = np.zeros(len(line), bool)
    double[1:] = (line[1:] == EDGE) & (line[:-1] == EDGE) & (rows[1:] == rows[:-1])
    line, rows = line[~double], rows[~double]
    grams = np.lib.stride_tricks.sliding_window_view(line, spec.gram) if len(line) >= spec.gram else np.empty((0, spec.gram), np.uint32)
    same = rows[: len(grams)] == rows[spec.gram - 1 :] if len(grams) else np.empty(0, bool)
    return rows[: len(grams)][same], grams[same]


def text_vectors(block: Block, spec: ProfileSpec) -> Iterator[tuple[int, np.ndarray]]:
    """First row and bundled vectors (float32) of a few texts at a time; a text without letters has a zero vector."""
    rows, grams = text_grams(block, spec)
    # 21 bits hold a code point, so up to three make a key that is the n-gram itself; longer ones are hashed.
    keys = np.zeros(len(grams), np.uint64)
    with np.errstate(over="ignore"):
        for place in range(spec.gram):
            keys = (keys << np.uint64(21)) + grams[:, place] if spec.gram <= 3 else mix(keys + grams[:, place] + np.uint64(1))
    for first in range(0, len(block), ROWS):
        last = min(first + ROWS, len(block))
        a, b = np.searchsorted(rows, [first, last])
        out = np.zeros((last - first, spec.size), np.float32)
        if b > a:
            _, one, at = np.unique(keys[a:b], return_index=True, return_inverse=True)
            for low in range(0, len(one), 4096):  # distinct n-grams bound at a time
                high = min(low + 4096, len(one))
                part = (at >= low) & (at < high)
                cells = (rows[a:b][part] - first) * (high - low) + at[part] - low
                counts = np.bincount(cells, minlength=(last - first) * (high - low)).reshape(last - first, high - low)
                out += counts.astype(np.float32) @ gram_vectors(grams[a:b][one[low:high]], spec).astype(np.float32)
        yield first, out


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    vectors: np.ndarray  # one row for each language, of length one


def training_texts(labelled: DataFrame, spec: ProfileSpec) -> DataFrame:
    """``text, lang`` of about ``most_rows`` distinct (id, text) pairs of each language, all where there are fewer.

    Repeated rows count once, so neither an id nor a text that fills a third of the table takes the places of the
    others, and the sample is bounded in rows. Of more than ``most_languages`` languages, those with the most
    pairs are learned, of equally frequent ones the first in order.
    """
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("doc_id", "text"), 0.02).alias("n"))
    learned = sizes.orderBy(F.col("n").desc(), "lang").limit(spec.most_languages)
    share = F.lit(spec.most_rows * 1_000_000) / F.col("n")
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1_000_000))
    chosen = labelled.select("doc_id", "text", "lang").join(F.broadcast(learned), "lang").filter(place < share)
    return chosen.select("doc_id", "text", "lang").distinct().select("text", "lang")


def fit(docs: DataFrame, spec: ProfileSpec = ProfileSpec()) -> Profiles:
    """Profiles from ``docs(doc_id, text, lang)``; rows without a language or an id are left out.

    A profile is the sum of its texts' vectors, each brought to length one, over ``training_texts``. The driver gets
    ``size`` numbers for each of at most ``most_languages`` languages.
    """
    schema = pa.schema([("lang", pa.string()), ("vector", pa.list_(pa.float64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, block in text_blocks(batch.column(0)):
                for row, vectors in text_vectors(block, spec):
                    length = np.linalg.norm(vectors, axis=1, keepdims=True)
                    vectors = vectors / np.where(length > 0, length, 1)
                    for k, vector in enumerate(vectors):
                        lang = langs[first + row + k]
                        sums[lang] = sums.get(lang, 0) + vector.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(list(sums.values()), schema.field(1).type)], schema=schema)

    labelled = docs.filter("lang is not null and doc_id is not null")
    parts = training_texts(labelled, spec).mapInArrow(work, "lang string, vector array<double>")
    totals = parts.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col").alias("x")).toArrow()
    languages, at = np.unique(np.array(totals.column("lang").to_pylist(), object), return_inverse=True)
    vectors = np.zeros((len(languages), spec.size))
    vectors[at, totals.column("pos").to_numpy()] = totals.column("x").to_numpy()
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Profiles(languages.tolist(), vectors / np.where(length > 0, length, 1))


def predict(docs: DataFrame, profiles: Profiles, spec: ProfileSpec = ProfileSpec()) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs(doc_id, text)``; the score is the cosine, 0 at least."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, UNKNOWN], object)
        towards = known.vectors.T.astype(np.float32)
        for batch in batches:
            for first, block in text_blocks(batch.column(1)):
                for row, vectors in text_vectors(block, spec):
                    length = np.linalg.norm(vectors, axis=1)
                    cosines = (vectors @ towards) / np.where(length > 0, length, 1)[:, None]
                    none = length == 0
                    if not len(known.languages):
                        none[:], cosines = True, np.zeros((len(vectors), 1))
                    best = np.where(none, len(known.languages), cosines.argmax(1))
                    score = np.where(none, 0, np.clip(cosines.max(1), 0, 1)).astype(np.float64)
                    columns = [batch.column(0).slice(first + row, len(vectors)), pa.array(names[best]), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, lang_pred string, score double")


def identify(
    docs: DataFrame, learn_from: Column, spec: ProfileSpec = ProfileSpec(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Fits on the rows for which ``learn_from`` (a condition on ``doc_id``) holds, and predicts every row.

    Texts that are null or without a letter get ``und`` and score 0, as every text does if nothing was learned. Of
    languages with equal cosines the first in code-point order is predicted. Equal texts are judged alike.
    """
    texts = documents(docs, id_col, text_col, lang=lang_col)
    return predict(texts, fit(texts.filter(learn_from), spec), spec)
