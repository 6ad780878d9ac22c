"""Hashed word features: of blocks of text inside tasks, and as bounded training tables on Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Block, mix, span_hashes, spans, text_blocks
from .tables import stage

BITS = 28  # features are numbers below 2**BITS
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = UPPER.copy()
LETTER[97:123] = LETTER[0x80:] = True  # beyond ASCII every byte counts as part of a word
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

# Fixed odd multipliers that keep the kinds of features apart.
PAIR, SKIP, SYMBOL, SHAPE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))

Features = Callable[[Block], tuple[np.ndarray, np.ndarray]]


def _index(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int32)


def words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of letters, A-Z lower-cased, in order."""
    begins, lengths, rows = spans(LETTER[block.data], block.starts)
    return span_hashes(LOWER[block.data], begins, lengths)[0], rows


def joined(hashes: np.ndarray, rows: np.ndarray, apart: int, kind: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of the pairs of words that stand ``apart`` places from each other in a row."""
    same = rows[:-apart] == rows[apart:]
    with np.errstate(over="ignore"):
        return mix(hashes[:-apart][same] * kind + hashes[apart:][same]), rows[apart:][same]


def grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Words, word pairs and pairs with one word left out: row and feature of each occurrence."""
    hashes, rows = words(block)
    parts = [(hashes, rows), joined(hashes, rows, 1, PAIR), joined(hashes, rows, 2, SKIP)]
    return np.concatenate([r for _, r in parts]), _index(np.concatenate([h for h, _ in parts]))


def style(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Words, runs of symbols, shapes of space-separated tokens, words right after themselves: row and feature of each.

    A shape tells whether a token is in capitals, capitalised, without letters, and on which symbols it ends.
    """
    data = block.data
    hashes, rows = words(block)
    symbol = ~(LETTER | BLANK)[data]
    begins, lengths, symbol_rows = spans(symbol, block.starts)
    marks = span_hashes(data, begins, lengths)[0]
    starts, sizes, token_rows = spans(~BLANK[data], block.starts)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int32)
    capitals = np.add.reduceat(np.append(UPPER[data], False).astype(np.int32), np.stack([starts, starts + sizes], 1).ravel())[::2]
    letters = np.add.reduceat(np.append(LETTER[data], False).astype(np.int32), np.stack([starts, starts + sizes], 1).ravel())[::2]
    case = np.select([letters == 0, (capitals == letters) & (letters > 1), UPPER[data[starts]]], [0, 1, 2], 3).astype(np.uint64)
    last = starts + sizes - 1
    ends = np.where(symbol[last], np.minimum(np.searchsorted(begins, last, side="right") - 1, len(begins) - 1), -1)
    tail = np.where(ends >= 0, marks[ends] if len(marks) else 0, np.uint64(7)).astype(np.uint64)
    with np.errstate(over="ignore"):
        shapes = mix(tail * SHAPE + case)
        marks = mix(marks * SYMBOL)
    again = rows[1:][(hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])]
    repeats = np.full(len(again), SHAPE)
    return np.concatenate([rows, symbol_rows, token_rows, again]), _index(np.concatenate([hashes, marks, shapes, repeats]))


def row_features(features: Features, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and count of the distinct features of each row, by row and feature."""
    rows, found = features(block)
    keys, counts = np.unique((rows.astype(np.int64) << BITS) | found, return_counts=True)
    return keys >> BITS, (keys & ((1 << BITS) - 1)).astype(np.int32), counts.astype(np.int32)


def sampled(labelled: DataFrame, label: str, most: int) -> DataFrame:
    """About ``most`` rows of each label of ``labelled(doc_id, label)``, all where there are fewer; by a hash of the id."""
    counts = {r[label]: r["n"] for r in labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per label
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col(label) == value, F.lit(min(1_000_000, most * 1_000_000 // n))).otherwise(share)
    return labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < share)


TRAINING = "label int, shard int, place long, found array<int>, counts array<int>"


def training_rows(docs: DataFrame, sample: DataFrame, features: Features, shards: int) -> DataFrame:
    """Features of the sampled texts, written: ``label, shard, place, found, counts``.

    ``sample(doc_id, label)`` is bounded by its maker and broadcast; the texts stay where they are. Of several rows
    with one id, the one whose features have the least hash is used, so that the bound holds for rows, too.
    """
    schema = pa.schema(
        [("label", pa.int32()), ("shard", pa.int32()), ("place", pa.int64()), ("found", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, block in text_blocks(batch.column(3)):
                rows, found, counts = row_features(features, block)
                offsets = pa.array(np.searchsorted(rows, np.arange(len(block) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (found, counts)]
                yield pa.RecordBatch.from_arrays([*(c.slice(first, len(block)) for c in batch.columns[:3]), *lists], schema=schema)

    order = F.xxhash64("doc_id", F.lit("order"))
    texts = docs.join(F.broadcast(sample), "doc_id").select(
        F.col("label").cast("int").alias("label"), F.pmod(order, F.lit(shards)).cast("int").alias("shard"), order.alias("place"), "text"
    )
    keys = ["label", "shard", "place"]
    each = F.struct(F.xxhash64("found", "counts").alias("hash"), "found", "counts")
    one = texts.mapInArrow(work, TRAINING).groupBy(*keys).agg(F.min(each).alias("x"))
    return stage(one.select(*keys, "x.found", "x.counts"), "training")


def vocabulary(rows: DataFrame, least: int) -> np.ndarray:
    """Sorted features that at least ``least`` training rows have; bounded as the training rows are."""
    counted = rows.select(F.explode("found").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return np.sort(counted.select("f").toArrow().column("f").to_numpy().astype(np.int32))


SHARD = "labels array<int>, sizes array<int>, found array<int>, counts array<int>"


def shard_rows(rows: DataFrame, known: np.ndarray) -> DataFrame:
    """The training rows by shard, one row each, written: labels, numbers of features, features and counts in order.

    Features are places in the vocabulary here; those outside it are left out. A shard is bounded as the sample is.
    """
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def gathered(table):
        table = table.sort_by("place").combine_chunks()
        lists = [table.column(c).combine_chunks() for c in ("found", "counts")]
        found, counts = (x.flatten().to_numpy() for x in lists)
        row = np.repeat(np.arange(len(table)), lists[0].value_lengths().to_numpy())
        at, there = lookup(shared.value, found)
        sizes = np.bincount(row[there], minlength=len(table))
        columns = [table.column("label").to_numpy(), sizes, at[there], counts[there]]
        return pa.table([pa.array([c.astype(np.int32)]) for c in columns], names=["labels", "sizes", "found", "counts"])

    return stage(rows.groupBy("shard").applyInArrow(gathered, SHARD), "shards")


def lookup(known: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each feature in the sorted ``known`` ones, and whether it is there."""
    if not len(known):
        return np.zeros(len(found), np.int64), np.zeros(len(found), bool)
    # A small filter first: most features of a text are not known.
    low = np.zeros(1 << 16, bool)
    low[known & 0xFFFF] = True
    maybe = np.flatnonzero(low[found & 0xFFFF])
    at = np.zeros(len(found), np.int64)
    at[maybe] = np.minimum(np.searchsorted(known, found[maybe]), len(known) - 1)
    there = np.zeros(len(found), bool)
    there[maybe] = known[at[maybe]] == found[maybe]
    return at, there


Learn = Callable[[list[np.ndarray], list[np.ndarray], list[np.ndarray], np.ndarray], list[np.ndarray]]


def mixed_epochs(shards: DataFrame, state: list[np.ndarray], learn: Learn, epochs: int) -> list[np.ndarray]:
    """Trains by parameter mixing: every shard learns from the same state, and its changes are averaged each epoch.

    ``learn(state, found, counts, labels)`` runs over the rows of one shard and returns its new state, arrays of
    equal length. The places that a shard changed go to the driver: at most the vocabulary for each shard.
    """
    context = shards.sparkSession.sparkContext
    number = shards.count()
    schema = pa.schema([("at", pa.list_(pa.int32())), *((f"d{k}", pa.list_(pa.float32())) for k in range(len(state)))])

    def step(shared):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(len(batch)):
                    labels, sizes, found, counts = (c[row].values.to_numpy() for c in batch.columns)
                    split = np.cumsum(sizes)[:-1]
                    old = shared.value
                    new = learn([x.copy() for x in old], np.split(found, split), np.split(counts, split), labels)
                    changed = np.flatnonzero(np.any([a != b for a, b in zip(old, new, strict=True)], axis=0))
                    columns = [changed, *(b[changed] - a[changed] for a, b in zip(old, new, strict=True))]
                    yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        return work

    for _ in range(epochs if number else 0):
        shared = context.broadcast(state)
        kinds = ", ".join(["at array<int>", *(f"d{k} array<float>" for k in range(len(state)))])
        state = [x.copy() for x in state]
        for batch in shards.mapInArrow(step(shared), kinds).toArrow().to_batches():
            for row in range(len(batch)):
                at = batch.column(0)[row].values.to_numpy()
                for x, delta in zip(state, batch.columns[1:], strict=True):
                    x[at] += delta[row].values.to_numpy() / number
        shared.destroy()
    return state
