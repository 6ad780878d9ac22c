"""Boosting trees grown from histograms of binned rows, for training frames that are too large to be held as vectors.

MLlib keeps a vector of doubles and one of whole numbers for each row, in memory or on the disks of the executors. Here a row is
one byte for each feature, its label and the sum of the trees so far, written once in blocks of rows. A level of a tree is one pass
over them: each task adds up rows, targets and squared targets by node, feature and bin, and what is shuffled and goes to the driver
are these sums, which grow with the model, not with the rows. Bins, gains, limits and leaves follow MLlib's regression trees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import ceil
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BoostSpec

POINTS = "points binary, labels binary, sums binary"
BLOCK_ROWS = 64  # rows in one value of a binned table
CHUNK = 16_384  # rows that a task works on at a time
SAMPLE = 10_000  # rows, or the square of the bins, from which bins are cut, as in MLlib
TINY = 2.0**-52
ROUNDING = 1e-13


def _kind(bins: int) -> type:
    return np.uint8 if bins <= 256 else np.uint16


def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Increasing thresholds that part the values into up to ``bins`` bins of about equally many."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(distinct) <= bins:
        return middles
    stride = target = len(values) / bins
    upto, chosen = np.cumsum(counts), []
    for k, middle in enumerate(middles):
        if abs(upto[k] - target) < abs(upto[k + 1] - target):
            chosen.append(middle)
            target += stride
    return np.array(chosen)


def feature_cuts(df: DataFrame, features: Sequence[str], rows: int, bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds of each feature, from all rows of a small frame and a sample of ``SAMPLE`` rows of a large one."""
    wanted = max(SAMPLE, bins**2)
    some = df.sample(wanted / rows, seed) if rows > wanted else df
    # The one time that rows go to the driver; their number is fixed.
    table = some.select(*[F.col(c).cast("double").alias(str(i)) for i, c in enumerate(features)]).toArrow()
    values = (column.to_numpy() for column in table.columns)
    return [cut_points(v[np.isfinite(v)], min(bins, rows)) for v in values]


def _blocks(values: np.ndarray) -> pa.Array:
    data, step = values.tobytes(), max(1, BLOCK_ROWS * values[:1].nbytes)
    return pa.array([data[i : i + step] for i in range(0, len(data), step)], pa.binary())


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    """The rows of all blocks of a column, which lie one after the other in its buffer."""
    column = column.cast(pa.binary())
    if not len(column):
        return np.empty(0, kind)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind)


def binned(df: DataFrame, features: Sequence[str], label: Column, cuts: Sequence[np.ndarray], bins: int, strict: bool) -> DataFrame:
    """Blocks of rows: the bins of their features, their labels, and 0 as the sum of the trees so far.

    ``strict``, for training rows, refuses missing and infinite values as MLlib does; elsewhere they go into the last bin.
    """
    kind = _kind(bins)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, 1 + len(cuts))
            if strict and not np.isfinite(values).all():
                raise ValueError("labels and features of training rows must not be missing or infinite")
            points = np.empty((len(values), len(cuts)), kind)
            for k, thresholds in enumerate(cuts):
                points[:, k] = np.searchsorted(thresholds, values[:, k + 1])
            parts = [_blocks(x) for x in (points, values[:, 0], np.zeros(len(values)))]
            yield pa.RecordBatch.from_arrays(parts, ["points", "labels", "sums"])

    # One array, since handing over many columns row by row takes far longer than the work on them.
    slim = df.select(F.array(label.cast("double"), *[F.col(c).cast("double") for c in features]).alias("values"))
    return slim.mapInArrow(work, POINTS)


@dataclass
class Tree:
    """Nodes in the order in which they were made. Rows in bins up to ``cut`` go ``low``; a leaf has feature -1."""

    feature: list[int]
    cut: list[int]
    low: list[int]
    high: list[int]
    gain: list[float]
    sums: list[tuple[float, float, float]]  # rows, targets, squared targets

    @classmethod
    def root(cls) -> "Tree":
        tree = cls([], [], [], [], [], [])
        tree.add((0.0, 0.0, 0.0))
        return tree

    def add(self, sums: Sequence[float]) -> int:
        for column, value in zip((self.feature, self.cut, self.low, self.high, self.gain), (-1, 0, -1, -1, 0.0), strict=True):
            column.append(value)
        self.sums.append(tuple(map(float, sums)))
        return len(self.sums) - 1

    def split(self, node: int, feature: int, cut: int, gain: float, low: Sequence[float], high: Sequence[float]) -> list[int]:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.low[node], self.high[node] = self.add(low), self.add(high)
        return [self.low[node], self.high[node]]

    def value(self, node: int) -> float:
        rows, total, _ = self.sums[node]
        return total / rows if rows else 0.0

    def variance(self, node: int) -> float:
        return float(_variance(*map(np.float64, self.sums[node]))) if self.sums[node][0] else 0.0

    def scorer(self, values: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        """For bins with a row for each feature: the value of the node in which each column ends.

        Node by node over all columns, since whole bytes are compared and chosen many at a time.
        """

        def below(points: np.ndarray, k: int):
            if self.feature[k] < 0:
                return values[k]
            return np.where(points[self.feature[k]] <= self.cut[k], below(points, self.low[k]), below(points, self.high[k]))

        return lambda points: np.broadcast_to(below(points, 0), points.shape[1])

    def forecaster(self) -> Callable[[np.ndarray], np.ndarray]:
        return self.scorer(np.array([self.value(k) for k in range(len(self.sums))]))

    def model(self, cuts: Sequence[np.ndarray]) -> DecisionTreeRegressionModel:
        """The tree as MLlib's; Python has no constructors for its nodes, so those in the JVM are called."""
        context = SparkSession.getActiveSession().sparkContext
        jvm, gateway = context._jvm.org.apache.spark, context._gateway

        def node(k: int):
            numbers = gateway.new_array(context._jvm.double, 3)
            for i, x in enumerate(self.sums[k]):
                numbers[i] = x
            stats = jvm.mllib.tree.impurity.VarianceCalculator(numbers, int(self.sums[k][0]))
            shown = self.value(k), self.variance(k)
            if self.feature[k] < 0:
                return jvm.ml.tree.LeafNode(*shown, stats), True
            (low, a), (high, b) = node(self.low[k]), node(self.high[k])
            if a and b and low.prediction() == high.prediction():
                return jvm.ml.tree.LeafNode(*shown, stats), True
            split = jvm.ml.tree.ContinuousSplit(self.feature[k], float(cuts[self.feature[k]][self.cut[k]]))
            return jvm.ml.tree.InternalNode(*shown, self.gain[k], low, high, split, stats), False

        made = jvm.ml.regression.DecisionTreeRegressionModel(f"dtr_{uuid4().hex[:12]}", node(0)[0], len(cuts))
        return DecisionTreeRegressionModel._from_java(made)


def _variance(rows: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    return (squares - total * total / rows) / rows


def _chunks(batches: Iterator[pa.RecordBatch], width: int, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins with a row for each feature, labels and sums."""
    for batch in batches:
        points, labels, sums = (_rows(c, k) for c, k in zip(batch.columns, (kind, np.float64, np.float64), strict=True))
        points = points.reshape(-1, width)
        for i in range(0, len(labels), CHUNK):
            at = slice(i, i + CHUNK)
            yield np.ascontiguousarray(points[at].T), labels[at], sums[at]


def _added(trees: Sequence[Tree], weights: Sequence[float]) -> Callable[[np.ndarray, np.ndarray], Iterator[np.ndarray]]:
    """The sums after each of the trees."""
    scorers = [(tree.forecaster(), weight) for tree, weight in zip(trees, weights, strict=True)]

    def after(points: np.ndarray, sums: np.ndarray) -> Iterator[np.ndarray]:
        for scorer, weight in scorers:
            sums = sums + weight * scorer(points)
            yield sums

    return after


def _histograms(
    rows: DataFrame, tree: Tree, nodes: Sequence[int], after: Callable, first: bool, spec: BoostSpec, seed: int, width: int, bins: int
) -> np.ndarray:
    """(nodes, 3, features, bins): rows, targets and squared targets of the given nodes of an unfinished tree."""
    slots, kind = len(nodes), _kind(bins)
    slot_of = np.full(len(tree.sums), -1)
    slot_of[list(nodes)] = np.arange(slots)
    slot_in, size = tree.scorer(slot_of), slots * bins

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((3, width, size))
        # As in MLlib, a row's part in a tree hangs on its place, which is the same in each pass over a written table.
        chance = np.random.default_rng([seed, TaskContext.get().partitionId()]) if spec.row_share < 1 else None
        for points, labels, sums in _chunks(batches, width, kind):
            slot = slot_in(points)
            used = slot >= 0
            if chance is not None:
                used &= chance.random(len(labels)) < spec.row_share
            if not used.all():
                points, labels, sums, slot = points[:, used], labels[used], sums[used], slot[used]
            for now in after(points, sums):
                sums = now
            # The first tree counts in full, the later ones fit the gradient of the squared error.
            target = labels if first else 2 * (labels - sums)
            squares, base = target * target, slot * bins
            for k in range(width):
                at = base + points[k]
                for part, weight in zip(found, (None, target, squares), strict=True):
                    part[k] += np.bincount(at, weight, size)
        at = np.flatnonzero(found[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(part.reshape(-1)[at]) for part in found)], ["at", "n", "s", "q"])

    each = rows.mapInArrow(work, "at long, n double, s double, q double")
    table = each.groupBy("at").agg(F.sum("n"), F.sum("s"), F.sum("q")).toArrow()
    at, *parts = (c.to_numpy() for c in table.columns)
    out = np.zeros((3, width * size))
    out[:, at] = parts
    return out.reshape(3, width, slots, bins).transpose(2, 0, 1, 3)


def _best_split(sums: Sequence[float], found: np.ndarray, spec: BoostSpec, chosen: np.ndarray) -> tuple | None:
    """(feature, cut, gain, sums below, sums above) of the split with the largest gain, if one gains anything.

    Gains that differ by their rounding only are equal, and the first of them wins, in whatever order the sums were added up.
    """
    low = np.cumsum(found, axis=2)[:, :, :-1]
    high = np.array(sums)[:, None, None] - low
    most = np.float64(sums[0])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _variance(*map(np.float64, sums)) - low[0] / most * _variance(*low) - high[0] / most * _variance(*high)
    fits = (low[0] >= spec.min_rows) & (high[0] >= spec.min_rows) & (low[0] > 0) & (high[0] > 0) & chosen[:, None]
    gain = np.where(fits, gain, -np.inf)
    if not gain.size or gain.max() <= 0:
        return None
    rounding = ROUNDING * sums[2] / sums[0]
    feature, cut = np.unravel_index(np.argmax(gain >= gain.max() - rounding), gain.shape)
    return int(feature), int(cut), float(gain[feature, cut]), low[:, feature, cut], high[:, feature, cut]


def grow(rows: DataFrame, trees: Sequence[Tree], weights: Sequence[float], spec: BoostSpec, number: int, width: int, bins: int) -> Tree:
    """The tree of that number, level by level; ``trees`` are those before it that the rows' sums lack.

    Of the two nodes below a split the rows of the smaller one are added up; the other one has the rest of the node above.
    """
    tree, seed, after = Tree.root(), spec.seed + number, _added(trees, weights)

    def look(nodes: Sequence[int]) -> dict[int, np.ndarray]:
        return dict(zip(nodes, _histograms(rows, tree, nodes, after, number == 0, spec, seed, width, bins), strict=True))

    found = look([0])
    tree.sums[0] = tuple(map(float, found[0][:, 0].sum(axis=1)))
    for level in range(spec.depth):
        split, smaller = [], []
        for node, sums in found.items():
            chosen = np.ones(width, bool)
            if spec.column_share < 1:
                some = np.random.default_rng([seed, node]).permutation(width)
                chosen[some[ceil(spec.column_share * width) :]] = False
            best = _best_split(tree.sums[node], sums, spec, chosen)
            if best:
                pair = sorted(tree.split(node, *best), key=lambda k: tree.sums[k][0])
                split.append((sums, *pair))
                smaller.append(pair[0])
        if not split or level + 1 == spec.depth:
            break
        counted, found = look(smaller), {}
        for whole, small, large in split:
            for node, sums in ((small, counted[small]), (large, whole - counted[small])):
                if abs(tree.variance(node)) >= TINY:
                    found[node] = sums
    return tree


def errors(rows: DataFrame, trees: Sequence[Tree], weights: Sequence[float], width: int, bins: int) -> list[float]:
    """Mean squared error after each of the trees, from one pass."""
    after, kind = _added(trees, weights), _kind(bins)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, count = np.zeros(len(trees)), 0
        for points, labels, sums in _chunks(batches, width, kind):
            totals += [((labels - now) ** 2).sum() for now in after(points, sums)]
            count += len(labels)
        numbers = np.arange(len(trees))
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(totals), pa.array(np.full(len(trees), count))], ["tree", "total", "n"])

    each = rows.mapInArrow(work, "tree long, total double, n long").groupBy("tree")
    found = each.agg((F.sum("total") / F.sum("n")).alias("error")).orderBy("tree").collect()  # one row for each tree
    return [r["error"] for r in found]


def advanced(rows: DataFrame, trees: Sequence[Tree], weights: Sequence[float], width: int, bins: int) -> DataFrame:
    """The rows with the trees added to their sums."""
    after, kind = _added(trees, weights), _kind(bins)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.empty(0), *(list(after(p, sums))[-1] for p, _, sums in _chunks(iter([batch]), width, kind))]
            sizes = [len(x) // 8 for x in batch.column(2).to_pylist()]
            data, ends = np.concatenate(made).tobytes(), np.cumsum([0, *sizes]) * 8
            new = pa.array([data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), new], ["points", "labels", "sums"])

    return rows.mapInArrow(work, POINTS)
