"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets a key of random hash bits (signs of projections) one after another, and the
vectors of a label are put in the order of their keys. Close vectors agree in most bits and so come to stand
near each other; every vector is compared with a bounded number of followers, exactly and in double precision.
Passes have hashes of their own; the verified pairs of all of them are united.

The larger a label, the fewer leading bits two close vectors need to differ in to come to stand far apart, so
labels get passes by their size. Neighbours on two sides of a partition's edge are compared in a second step.

What the passes link makes components. Inside a component all pairs are compared, by blocks where it is large,
so that the links of its vectors are counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .tables import stage


@dataclass(frozen=True)
class PassSpec:
    passes: int = 12  # at least, for labels of every size
    recall: float = 0.99  # expected share of found links whose cosine is the threshold; sets the passes of large labels
    together: int = 4  # passes that share a shuffle, which holds the vectors once for each
    bits: int = 48  # of a key; enough to order 10^12 vectors
    window: int = 128  # followers that a vector is compared with in each pass
    threshold: float = 0.93
    seed: int = 20
    block: int = 2048  # vectors of a large component that are compared with each other at a time
    shared: int = 512  # vectors of small components that are compared in one group


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def sort_keys(vectors: np.ndarray, number: int, spec: PassSpec) -> np.ndarray:
    """Key of each vector in one pass: the signs of its projections as the bits of a number."""
    planes = np.random.default_rng([spec.seed, number, vectors.shape[1]]).standard_normal((vectors.shape[1], spec.bits))
    return (vectors @ planes > 0) @ (1 << np.arange(spec.bits - 1, -1, -1, dtype=np.int64))


def _usable(column: str) -> Column:
    """Vectors that can link: no null or non-finite component, not all zero."""
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))


def passes_needed(vectors: Column, spec: PassSpec) -> Column:
    """Passes for a label of so many vectors.

    Two vectors at the threshold agree in a bit with probability ``1 - angle / pi``. They meet in a pass if they
    agree in the leading bits that cut the label down to ``window`` vectors; the passes are independent, and as
    many are made as miss such a pair with probability ``1 - recall`` at most.
    """
    agree = 1 - math.acos(spec.threshold) / math.pi
    meet = F.pow(F.lit(agree), F.log2(vectors / spec.window))
    needed = F.ceil(math.log(1 - spec.recall) / F.log(1 - meet))
    return F.when(vectors > spec.window, F.greatest(F.lit(spec.passes), needed)).otherwise(spec.passes).cast("int")


MET = pa.schema(
    [("a", pa.int64()), ("b", pa.int64()), ("seam", pa.int64()), ("place", pa.int32()), ("pass", pa.int32()), ("label", pa.int64())]
    + [("dims", pa.int32()), ("rep", pa.int64()), ("vector", pa.list_(pa.float64()))]
)


def _found(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = [pa.nulls(len(a), kind) for kind in MET.types[2:]]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *none], schema=MET)


def _seam_rows(rows: pa.Table, seam: int, first: int) -> list[pa.RecordBatch]:
    """Rows at an edge of a partition; those before the seam have places below 0."""
    n, none = len(rows), pa.nulls(len(rows), pa.int64())
    place = pa.array(np.arange(first, first + n, dtype=np.int32))
    columns = [none, none, pa.array(np.full(n, seam)), place, *(rows.column(c).cast(MET.field(c).type) for c in MET.names[4:])]
    return pa.Table.from_arrays(columns, schema=MET).to_batches()


def _across(rows: pa.Table, spec: PassSpec) -> pa.Table:
    """Links between the last rows before a seam and the first ones after it."""
    links = [pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})]
    kinds = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("pass", "label", "dims")], 1)
    places, reps = rows.column("place").to_numpy(), rows.column("rep").to_numpy()
    for kind in np.unique(kinds, axis=0):
        same = (kinds == kind).all(1)
        before, after = np.flatnonzero(same & (places < 0)), np.flatnonzero(same & (places >= 0))
        if not len(before) or not len(after):
            continue
        left, right = (_unit(_matrix(rows.column("vector").take(pa.array(x)).combine_chunks())) for x in (before, after))
        near = (left @ right.T >= spec.threshold - 1e-9) & (places[after] - places[before][:, None] <= spec.window)
        i, j = np.nonzero(near)
        sure = np.einsum("ij,ij->i", left[i], right[j]) >= spec.threshold
        links.append(pa.table({"a": reps[before[i[sure]]], "b": reps[after[j[sure]]]}))
    return pa.concat_tables(links)


def pass_links(classes: DataFrame, numbers: range, spec: PassSpec) -> DataFrame:
    """Verified links ``(a, b)`` of some passes over ``classes(rep, label, size, vector, dims)``, in one shuffle.

    Each partition also hands on its first and last ``window`` rows; they meet those of the partition beside it.
    """
    names = ["pass", "label", "dims", "key", "rep", "vector"]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for size in np.unique(dims):  # usually one
                part = batch.filter(pa.array(dims == size))
                vectors = _matrix(part.column(3))
                for number in numbers:
                    keys = pa.array(sort_keys(vectors, number, spec))
                    which = pa.array(np.full(len(part), number, np.int32))
                    yield pa.RecordBatch.from_arrays([which, part.column(0), part.column(1), keys, part.column(2), part.column(3)], names=names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_hand = TaskContext.get().partitionId()
        head, tail = [], []
        held: tuple[tuple, np.ndarray, np.ndarray] | None = None  # the last rows, to be met by later batches
        for batch in batches:
            missing = spec.window - sum(map(len, head))
            if missing > 0:
                head.append(batch.slice(0, missing))
            tail.append(batch.slice(max(0, len(batch) - spec.window)))
            while sum(map(len, tail[1:])) >= spec.window:
                del tail[0]
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                kinds = np.stack([part.column(c).to_numpy().astype(np.int64) for c in range(3)], 1)
                # Rows come in order of pass, label and length.
                edges = np.flatnonzero((kinds[1:] != kinds[:-1]).any(1)) + 1
                for first, last in zip([0, *edges], [*edges, len(part)], strict=True):
                    kind, run = tuple(kinds[first]), part.slice(first, last - first)
                    reps, units, old = run.column(4).to_numpy(), _unit(_matrix(run.column(5))), 0
                    if held and held[0] == kind:
                        reps, units, old = np.concatenate([held[1], reps]), np.concatenate([held[2], units]), len(held[1])
                    i, j = np.nonzero(units @ units[old:].T >= spec.threshold - 1e-9)
                    j += old
                    near = (j > i) & (j - i <= spec.window)
                    i, j = i[near], j[near]
                    sure = np.einsum("ij,ij->i", units[i], units[j]) >= spec.threshold
                    yield _found(reps[i[sure]], reps[j[sure]])
                    held = (kind, reps[-spec.window :], units[-spec.window :])
        if head:
            last = pa.Table.from_batches(tail)
            last = last.slice(max(0, len(last) - spec.window))
            yield from _seam_rows(pa.Table.from_batches(head), at_hand, 0)
            yield from _seam_rows(last, at_hand + 1, -len(last))

    keys = classes.select("label", "dims", "rep", "vector").mapInArrow(
        keyed, "pass int, label long, dims int, key long, rep long, vector array<double>"
    )
    order = keys.repartitionByRange(*names[:5]).sortWithinPartitions(*names[:5])
    schema = "a long, b long, seam long, place int, pass int, label long, dims int, rep long, vector array<double>"
    met = stage(order.mapInArrow(compare, schema), "met")
    across = met.filter("seam is not null").groupBy("seam").applyInArrow(lambda rows: _across(rows, spec), "a long, b long")
    links = met.filter("a is not null").select("a", "b").union(across)
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _linked(rows: pa.Table, spec: PassSpec) -> pa.Table:
    """``rep, others``: what each vector of a pair of blocks links with in the other block, or in its own.

    A block holds vectors of one large component or of several small ones, which are told apart by ``least``.
    """
    block, low, high = (rows.column(c).to_numpy() for c in ("block", "low", "high"))
    reps, sizes, least = (rows.column(c).to_numpy() for c in ("rep", "size", "least"))
    units = _unit(_matrix(rows.column("vector").combine_chunks()))
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    alone = low[0] == high[0]
    others = np.zeros(len(reps), np.int64)
    for at in range(0, len(left), 512):
        part = left[at : at + 512]
        cosines = units[part] @ units[right].T
        near = (cosines >= spec.threshold - 1e-9) & (least[part][:, None] == least[right])
        i, j = np.nonzero(near & (cosines < spec.threshold + 1e-9))
        near[i, j] = np.einsum("ij,ij->i", units[part[i]], units[right[j]]) >= spec.threshold
        if alone:
            near[part[:, None] == right] = False
        others[part] += near @ sizes[right]
        if not alone:
            others[right] += sizes[part] @ near
    return pa.table({"rep": reps, "others": others})


def count_links(classes: DataFrame, labels: DataFrame, spec: PassSpec) -> DataFrame:
    """``rep, others`` for the vectors of all components ``labels(rep, least)``: all pairs of each are compared.

    A component of more than ``window`` vectors is cut into blocks by a hash and every two blocks meet in a group
    of their own; smaller ones share groups of about ``shared`` vectors.
    """
    large = labels.groupBy("least").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > spec.window)
    large = stage(large.select("least", F.ceil(F.col("n") / spec.block).alias("blocks")), "large")
    placed = stage(labels.join(large, "least", "left"), "placed")
    groups = 1 + placed.filter("blocks is null").count() // spec.shared
    is_small = F.col("blocks").isNull()
    rows = classes.join(placed, "rep").select(
        "least", "dims", "rep", "size", "vector",
        is_small.alias("small"),
        F.when(is_small, F.pmod(F.xxhash64("least"), F.lit(groups))).otherwise(F.col("least")).alias("home"),
        F.coalesce("blocks", F.lit(1)).alias("blocks"),
    )
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("blocks", "other")
    counted = rows.groupBy("small", "home", "dims", "low", "high").applyInArrow(lambda table: _linked(table, spec), "rep long, others long")
    return counted.groupBy("rep").agg(F.sum("others").alias("others"))


def near_vectors(
    vectors: DataFrame, spec: PassSpec = PassSpec(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors are compared if their labels are equal and not null. Equal vectors are one class, linked in full;
    classes link if their cosine in double precision reaches the threshold and they meet in some pass or belong to
    one component. Labels of more than about 60,000 classes get more than ``passes`` passes (``passes_needed``).
    ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest id reachable, ``kept``
    tells whether that is the row's own. Vectors that are null, all zero or hold null or non-finite components
    link with nothing, nor do rows without an id.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable("vector")
    rows = stage(rows.withColumn("vector", F.when(usable, F.col("vector"))), "vectors")
    able = rows.filter("vector is not null")
    classes = able.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"))
    classes = stage(classes.withColumn("dims", F.size("vector")), "classes")
    counts = classes.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("n"))
    needed = counts.select("label", "dims", passes_needed(F.col("n"), spec).alias("needed"))
    larger = stage(needed.filter(F.col("needed") > spec.passes), "larger")
    most = larger.agg(F.max("needed")).first()[0] or spec.passes
    more = classes.join(larger, ["label", "dims"])
    found = []
    for low, high, members in ((0, spec.passes, classes), (spec.passes, most, more)):
        for first in range(low, high, spec.together):
            numbers = range(first, min(first + spec.together, high))
            part = members if low == 0 else members.filter(F.col("needed") > first)
            found.append(stage(pass_links(part, numbers, spec), "links"))
    links = stage(reduce(DataFrame.union, found).distinct(), "links")

    labels = stage(components(links).withColumnsRenamed({"node": "rep", "component": "least"}), "labels")
    others = stage(count_links(classes, labels, spec), "counted")
    known = classes.join(others, "rep", "left").join(labels, "rep", "left")
    known = known.select(
        "label", "vector", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n"), F.coalesce("least", "rep").alias("least")
    )
    joined = rows.join(known, ["label", "vector"], "left")
    joined = joined.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
    return joined.withColumn("kept", F.col("vec_id") == F.col("component_id"))
