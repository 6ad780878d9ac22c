"""Ranked lexical search of many items at once, with the sums that items share computed once.

The terms of the items are looked up in every document in one pass, which leaves narrow postings. An item's
score of a document is a sum over its terms; items share terms, so their sums share parts. The shared parts are
mined from the items alone: in each round the pairs of neighbouring terms that several items have become new
nodes, until no pair is shared. A document's partial sums are then worked out node by node, for a block of
documents at a time, and each item adds up the few nodes that it is left with. A task keeps the best documents
of each item, and the best of all tasks are ranked at the end.

Items are worked on in blocks of a bounded number of terms, so that what is broadcast does not grow with them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import BASES, Block, span_hashes, spans, text_blocks
from .tables import documents, stage

INSIDE = np.zeros(256, bool)
INSIDE[0x30:0x3A] = INSIDE[0x41:0x5B] = INSIDE[0x61:0x7B] = INSIDE[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

BEST = 10
BLOCK_TERMS = 1 << 18  # item terms that are worked on at once
CELLS = 1 << 22  # partial sums held at a time
NO_ID = np.iinfo(np.int64).max  # stands for a missing id, which ranks last


def terms_of(text: str | None) -> list[str]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased; a null text has none."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    begins, lengths, _ = spans(INSIDE[data], np.array([0, len(data)]))
    lowered = LOWER[data].tobytes()
    return [lowered[b : b + n].decode() for b, n in zip(begins.tolist(), lengths.tolist(), strict=True)]


class Vocabulary:
    """Finds the terms of the items among the words of texts, by two independent hashes."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        begins = np.cumsum(lengths) - lengths
        keys, checks = span_hashes(np.frombuffer(b"".join(raw), np.uint8), begins, lengths, BASES)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.checks, self.lengths = keys[self.order], checks[self.order], lengths[self.order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two terms have one hash")

    def __len__(self) -> int:
        return len(self.order)

    def find(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of words of each row; row and term of every word that is a term."""
        data = LOWER[block.data]
        begins, lengths, rows = spans(INSIDE[block.data], block.starts)
        counts = np.bincount(rows, minlength=len(block)).astype(np.int64)
        if not len(begins) or not len(self):
            return counts, np.empty(0, np.int64), np.empty(0, np.int64)
        keys = span_hashes(data, begins, lengths)[0]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self) - 1)
        hit = np.flatnonzero((self.keys[at] == keys) & (self.lengths[at] == lengths))
        at = at[hit]
        sure = span_hashes(data, begins[hit], lengths[hit], BASES[1:])[0] == self.checks[at]
        return counts, rows[hit][sure], self.order[at[sure]]


POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"


def postings(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: its words, and how often it has which of ``terms``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
    session = docs.sparkSession
    shared = session.sparkContext.broadcast(Vocabulary(terms))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        size = max(1, len(vocabulary))
        for batch in batches:
            for first, block in text_blocks(batch.column(1)):
                words, rows, found = vocabulary.find(block)
                keys, counts = np.unique(rows * size + found, return_counts=True)
                offsets = pa.array(np.searchsorted(keys // size, np.arange(len(block) + 1)), pa.int32())
                lists = [pa.array((keys % size).astype(np.int32)), pa.array(counts.astype(np.int32))]
                columns = [batch.column(0).slice(first, len(block)), pa.array(words)]
                columns += [pa.ListArray.from_arrays(offsets, values) for values in lists]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return documents(docs, id_col, text_col).mapInArrow(work, POSTINGS)


@dataclass
class Program:
    """How the scores of a block of items are summed up.

    Nodes 0 to ``len(leaf_terms)`` - 1 are terms times their repeats in an item; each later node is the sum of two
    before it, in levels of ``(lefts, rights)``. Item i is the sum of ``parts[starts[i]:starts[i + 1]]``.
    """

    leaf_terms: np.ndarray
    leaf_repeats: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    parts: np.ndarray
    starts: np.ndarray

    @property
    def nodes(self) -> int:
        return len(self.leaf_terms) + sum(len(left) for left, _ in self.levels)

    @property
    def additions(self) -> int:
        """For each document."""
        return self.nodes - len(self.leaf_terms) + len(self.parts) - len(self.starts) + 1

    def scores(self, leaves: np.ndarray) -> np.ndarray:
        """Scores (item, document) from the values (term, document)."""
        sums = np.empty((self.nodes, leaves.shape[1]), np.int64)
        done = len(self.leaf_terms)
        np.multiply(leaves[self.leaf_terms], self.leaf_repeats[:, None], out=sums[:done])
        for left, right in self.levels:
            np.add(sums[left], sums[right], out=sums[done : done + len(left)])
            done += len(left)
        return np.add.reduceat(sums[self.parts], self.starts[:-1], axis=0)


def sharing_program(items: list[dict[int, int]]) -> Program:
    """Mines the sums that several items share; ``items`` have a term's repeats by its number, none is empty.

    The terms of an item stand in the order of how many items have them, those that the same items have side by
    side. A round turns pairs of neighbours that two items or more have into nodes, the most frequent ones first,
    so there are about as many rounds as the logarithm of the longest shared run.
    """
    leaves: dict[tuple[int, int], int] = {}
    rows = [[leaves.setdefault(x, len(leaves)) for x in sorted(item.items())] for item in items]
    frequency = Counter(x for row in rows for x in row)
    holders = Counter()
    for number, row in enumerate(rows):
        mark = hash((number, 0))
        for x in row:
            holders[x] ^= mark
    rows = [sorted(row, key=lambda x: (-frequency[x], holders[x], x)) for row in rows]
    levels, nodes = [], len(leaves)
    while True:
        seen = Counter(pair for row in rows for pair in zip(row, row[1:]))
        shared = {pair: n for pair, n in seen.items() if n > 1}
        if not shared:
            break
        # A pair gives way to a neighbouring pair that more items have; the most frequent one never does.
        rank = {pair: (-n, pair) for pair, n in shared.items()}
        used: Counter = Counter()
        marked = []
        for row in rows:
            pairs = [rank.get(pair) for pair in zip(row, row[1:])]
            best = []
            for i, mine in enumerate(pairs):
                around = [p for p in (pairs[i - 1] if i else None, pairs[i + 1] if i + 1 < len(pairs) else None) if p]
                best.append(mine is not None and all(mine < p for p in around))
            marked.append(best)
            used.update(pair for pair, take in zip(zip(row, row[1:]), best) if take)
        made = {pair: nodes + i for i, pair in enumerate(p for p, n in used.items() if n > 1)}
        replaced = []
        for row, best in zip(rows, marked, strict=True):
            out, i = [], 0
            while i < len(row):
                node = made.get((row[i], row[i + 1])) if i < len(best) and best[i] else None
                out.append(row[i] if node is None else node)
                i += 1 if node is None else 2
            replaced.append(out)
        rows = replaced
        nodes += len(made)
        levels.append((np.array([a for a, _ in made], np.int64), np.array([b for _, b in made], np.int64)))
    starts = np.cumsum([0, *map(len, rows)])
    parts = np.array([x for row in rows for x in row], np.int64)
    keys = np.array(list(leaves), np.int64).reshape(-1, 2)
    return Program(keys[:, 0], keys[:, 1], levels, parts, starts)


def _best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, known: np.ndarray, best: int) -> np.ndarray:
    """Places of the ``best`` rows of each item: highest score, then lowest id, rows without an id last."""
    order = np.lexsort((doc, ~known, -score, item))
    ranked = item[order]
    begin = np.searchsorted(ranked, ranked, side="left")
    return order[np.arange(len(order)) - begin < best]


def _task_best(stored: DataFrame, program: Program, weights: np.ndarray, n_docs: int, n_words: int, best: int) -> DataFrame:
    """``item, doc_id, score``: the best documents of each item in each task."""
    shared = stored.sparkSession.sparkContext.broadcast((program, weights))
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weight = shared.value
        items = len(plan.starts) - 1
        width = max(1, CELLS // max(1, plan.nodes + len(weight)))
        least = np.ones(items, np.int64)  # scores that can still count
        held = [np.empty(0, np.int64) for _ in range(3)] + [np.empty(0, bool)]
        for batch in batches:
            ids = batch.column("doc_id")
            known = ~np.asarray(ids.is_null())
            doc = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
            n = batch.column("n").to_numpy()
            terms, counts = batch.column("terms"), batch.column("counts")
            edges = terms.offsets.to_numpy()
            term, count = (c.flatten().to_numpy().astype(np.int64) for c in (terms, counts))
            edges = edges - edges[0]
            row = np.repeat(np.arange(len(batch)), np.diff(edges))
            m = 100 - 75 + (75 * n * n_docs) // n_words
            value = weight[term] * ((1_000_000_000 * count) // (1000 * count + 8 * m[row]))
            for low in range(0, len(batch), width):
                high = min(low + width, len(batch))
                here = slice(edges[low], edges[high])
                leaves = np.zeros((len(weight), high - low), np.int64)
                leaves[term[here], row[here] - low] = value[here]
                scores = plan.scores(leaves)
                item, at = np.nonzero(scores >= least[:, None])
                new = [item, scores[item, at], doc[low + at], known[low + at]]
                held = [np.concatenate(x) for x in zip(held, new, strict=True)]
                held = [x[_best(*held, best)] for x in held] if len(item) else held
                # Ids come in any order: an equal score may still have a lower id.
                full = np.bincount(held[0], minlength=items) == best
                lowest = np.full(items, NO_ID)
                np.minimum.at(lowest, held[0], held[1])
                least = np.where(full, lowest, least)
        if len(held[0]):
            found = pa.array(held[2], mask=~held[3])
            yield pa.RecordBatch.from_arrays([pa.array(held[0].astype(np.int32)), found, pa.array(held[1])], schema=schema)

    return stored.mapInArrow(work, "item int, doc_id long, score long")


def weight(df: int, documents: int) -> int:
    """Rarer terms weigh more: a whole number, 0 at least."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _item_blocks(items: DataFrame, id_col: str, text_col: str, block_terms: int) -> list[list[tuple[int | None, Counter]]]:
    """The items in blocks of about ``block_terms`` terms: id and repeats of each term. Generated one block at a time."""
    named = items.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    sizes = named.agg(F.sum(F.length("text")), F.count(F.lit(1))).first()
    blocks = max(1, ceil((sizes[0] or 0) / 4 / block_terms))  # a term and its space take four characters or more, mostly
    held = stage(named.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "items")
    for block in range(blocks):
        found: dict[int | None, Counter] = {}
        for r in held.filter(F.col("block") == block).toLocalIterator():
            found.setdefault(r["item_id"], Counter()).update(terms_of(r["text"]))
        if rows := sorted(((i, c) for i, c in found.items() if c), key=lambda x: (x[0] is None, x[0] or 0)):
            yield rows


def rank(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``best`` documents of each item with a score above 0: ``item_id, rank, doc_id, score``.

    Scores are whole numbers (see ``weight`` and ``_task_best``): a term counts for more the rarer it is, with a
    bound on its repeats that falls with the length of the document. Equal scores are ranked by id, rows without an
    id last; each row with a repeated id is a document of its own. An item's repeated rows count once; different
    texts of one item id make one item, as does a missing item id. Null and empty texts have no terms, and an item
    without terms or matches has no rows.
    """
    session, found = docs.sparkSession, []
    for rows in _item_blocks(items, item_id_col, item_text_col, block_terms):
        terms = sorted({t for _, counts in rows for t in counts})
        number = {t: i for i, t in enumerate(terms)}
        stored = stage(postings(docs, terms, id_col, text_col), "postings")
        n_docs, n_words = stored.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        holding = stored.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        df = np.zeros(len(terms), np.int64)
        for r in holding.collect():  # a row for each term of the block
            df[r["term"]] = r["df"]
        weights = np.array([weight(int(x), n_docs) for x in df], np.int64)
        program = sharing_program([{number[t]: n for t, n in counts.items()} for _, counts in rows])
        names = session.createDataFrame([(i, item) for i, (item, _) in enumerate(rows)], "item int, item_id long")
        scored = _task_best(stored.filter(F.size("terms") > 0), program, weights, n_docs, n_words, best)
        found.append(scored.join(F.broadcast(names), "item").select("item_id", "doc_id", "score"))
    if not found:
        return session.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")
