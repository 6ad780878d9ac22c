"""SimHash near-duplicates by multi-index hashing.

Fingerprints within two bits agree, in a split into two halves, on the second half or come within one bit of
each other in the first. So each fingerprint looks up the Hamming ball of radius one of its first half (33
values) and its second half (1 value) in a table of the halves, and the whole distance of what it meets is
verified. Equal fingerprints are one class from the start.

A half that many fingerprints share makes a large bucket. Instead of comparing all its pairs, the fingerprints
that meet there give their 64 neighbours at one bit and themselves as keys: two fingerprints are within two
bits exactly if their balls of radius one share a key, and at most 65 fingerprints share one. They are linked
to the smallest of them, which leaves the components as all pairs would.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import text_blocks
from .graph import components
from .tables import documents, stage

SEED = 42
SHINGLE = 3
BUCKET = 64  # larger buckets are linked by shared neighbours instead of pair by pair
_FEW = 1 << 16  # hashes whose bits are counted at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, A-Z lower-cased; 0 for a text without words."""
    words = text.lower().split()  # on space and \t \n \v \f \r
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begins = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        view, digest = memoryview(joined), xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(view[a:b], SEED) for a, b in zip(begins, stops, strict=True)), np.uint64, len(begins))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _FEW):
        part = hashes[at : at + _FEW].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) for every row; a null text counts as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, block in text_blocks(batch.column(1)):
                found = np.fromiter((fingerprint(block.raw(r), shingle) for r in range(len(block))), np.uint64, len(block))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(block)), pa.array(found.view(np.int64))], schema=schema)

    return documents(docs, id_col, text_col).mapInArrow(work, "doc_id long, fp long")


def _halves(classes: DataFrame, flips: int) -> DataFrame:
    """``seg, val, fp, rep``: the halves of each fingerprint, the first with up to ``flips`` bits changed."""
    first = F.shiftrightunsigned("fp", 32)
    ball = [first] + ([first.bitwiseXOR(F.lit(1 << bit)) for bit in range(32)] if flips else [])
    keys = F.array(
        *[F.struct(F.lit(0).alias("seg"), v.alias("val")) for v in ball],
        F.struct(F.lit(1).alias("seg"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("val")),
    )
    return classes.select(F.inline(keys), "fp", "rep")


def close_fingerprints(classes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` between the ``rep`` of distinct fingerprints, enough to connect all within two bits.

    ``classes(fp, rep)`` is a written table with each fingerprint once. Pairs from small buckets are all there;
    pairs from large ones are connected through the smallest fingerprint near both.
    """
    table, probes = _halves(classes, 0), _halves(classes, 1)
    large = stage(table.groupBy("seg", "val").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket).select("seg", "val"), "large")
    left, right = probes.alias("x"), table.join(large, ["seg", "val"], "left_anti").alias("y")
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= 2
    same = (F.col("x.seg") == F.col("y.seg")) & (F.col("x.val") == F.col("y.val"))
    pairs = left.join(right, same & (F.col("x.fp") < F.col("y.fp")) & near)
    pairs = pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))

    meeting = probes.join(large, ["seg", "val"], "left_semi").select("fp", "rep").distinct()
    ball = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << bit if bit < 63 else -(1 << 63))) for bit in range(64)])
    # At most 65 distinct fingerprints lie within one bit of a key.
    around = meeting.select(F.explode(ball).alias("key"), "rep").groupBy("key").agg(F.collect_set("rep").alias("reps"))
    around = around.filter(F.size("reps") > 1)
    stars = around.select(F.explode("reps").alias("a"), F.array_min("reps").alias("b")).filter("a <> b")
    return pairs.union(stars)


def simhash_components(
    docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Rows whose fingerprints differ in two bits or fewer are linked; ``component_id`` is the smallest id that
    links reach. Texts without words have fingerprint zero and are linked like any other. Rows with equal ids
    are linked; a row without an id links like others, and has a null component if no row of it has an id.
    """
    prints = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    links = close_fingerprints(classes.select("fp", F.col("fp").alias("rep")), bucket)
    # An id that occurs with several fingerprints connects them.
    shared = prints.filter("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high")
    repeated = prints.join(shared.select("doc_id", "low"), "doc_id").filter("fp <> low")
    links = links.union(repeated.select(F.col("fp").alias("a"), F.col("low").alias("b")))
    found = components(links).withColumnsRenamed({"node": "fp", "component": "_node"})
    nodes = stage(classes.join(found, "fp", "left").select("fp", "least", F.coalesce("_node", "fp").alias("_node")), "nodes")
    least = nodes.groupBy("_node").agg(F.min("least").alias("component_id"))
    labels = nodes.join(least, "_node").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
