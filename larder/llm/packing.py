"""Best-fit packing by length patterns.

Documents become token pieces of at most ``limit`` tokens. Only the histogram of piece lengths, ``limit``
numbers whatever the size of the corpus, goes to the driver. There, patterns of one to three lengths that fill
a sequence exactly are enumerated, their repeat counts are fitted to the histogram by non-negative least
squares and rounded down to what is there, and the rest is packed best-fit, longest first, also on counts. The
resulting plan says for the k-th piece of each length where it goes; pieces are numbered within their length
in parallel and look their place up.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import text_blocks
from .chunks import byte_bpe
from .tables import documents, stage

PATTERNS = 8192  # patterns of three lengths that are fitted, those with the largest supply
ROWS_PER_BUCKET = 5000  # pieces of one length that are numbered together

PIECE_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def token_pieces(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, limit: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``.

    A document is its ids and then ``end_id``; a null or empty text is ``end_id`` alone. Documents of more than
    ``limit`` ids are cut into pieces of ``limit``, the first of which takes what is left over. Repeated rows
    are documents of their own; a null id stays null.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(tokenizer, ranks)
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for first, block in text_blocks(batch.column(1)):
                out: tuple[list, ...] = ([], [], [], [], [])
                for row, ids in enumerate(encoder.encode(block)):
                    ids = np.append(ids, end_id).astype("<u4")
                    start = 0
                    ends = range(len(ids) % limit or limit, len(ids) + 1, limit) if len(ids) > limit else (len(ids),)
                    for piece, end in enumerate(ends):
                        crc = zlib.crc32(ids[start:end].tobytes())
                        for column, value in zip(out, (ids_of[first + row], piece, start, end - start, crc), strict=True):
                            column.append(value)
                        start = end
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, PIECE_SCHEMA, strict=True)], schema=PIECE_SCHEMA)

    return documents(docs, id_col, text_col).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def patterns(counts: np.ndarray, limit: int) -> np.ndarray:
    """Rows of three lengths, largest first and 0 for none, that add up to ``limit`` and all occur.

    All patterns of one and two lengths, and the ``PATTERNS`` of three lengths with the largest supply.
    """
    have = counts > 0
    have[0] = True
    found = [np.array([[limit, 0, 0]])]
    a = np.arange((limit + 1) // 2, limit)
    found.append(np.stack([a, limit - a, np.zeros_like(a)], 1))
    b, c = np.meshgrid(np.arange(1, limit // 2 + 1), np.arange(1, limit // 3 + 1), indexing="ij")
    a = limit - b - c
    fits = (a >= b) & (b >= c)
    triples = np.stack([a[fits], b[fits], c[fits]], 1)
    triples = triples[have[triples].all(1)]
    supply = counts[triples].min(1)
    found.append(triples[np.argsort(-supply, kind="stable")[:PATTERNS]])
    every = np.concatenate(found)
    return every[have[every].all(1) & (every[:, 0] > 0)]


def fit_repeats(rows: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative least squares: repeats x >= 0 of the patterns such that their lengths come near ``counts``.

    Accelerated projected gradient; each residual is weighted by its count, so that rare lengths are fitted as
    closely as frequent ones.
    """
    size = len(counts)
    weight = 1 / np.maximum(counts, 1.0)
    weight[0] = 0  # length 0 stands for no document
    # No step may be longer than the largest eigenvalue allows; the largest row sum of A'WA bounds it.
    use = np.bincount(rows.ravel(), minlength=size) * 3.0
    step = 1 / np.maximum((weight * use)[rows].sum(1), 1e-12)
    x = y = np.zeros(len(rows))
    pace = 1.0
    for _ in range(steps):
        left = np.bincount(rows.ravel(), np.repeat(y, 3), size) - counts
        new = np.maximum(0, y - step * (weight * left)[rows].sum(1))
        ahead = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        y = new + (pace - 1) / ahead * (new - x)
        x, pace = new, ahead
    return x


def best_fit(counts: np.ndarray, limit: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Packs the counted lengths best-fit, longest first; returns (contents as (length, copies), sequences)."""
    open_: dict[int, list[list]] = defaultdict(list)
    spaces: list[int] = []

    def put(space: int, contents: tuple, number: int) -> None:
        if number:
            if not open_[space]:
                bisect.insort(spaces, space)
            open_[space].append([contents, number])

    for length in range(limit, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect.bisect_left(spaces, length)
            space = spaces[at] if at < len(spaces) else limit
            if at < len(spaces):
                contents, number = open_[space].pop()
                if not open_[space]:
                    spaces.pop(at)
            else:
                contents, number = (), -(-left // (limit // length))
            copies = min(space // length, left)
            full = min(number, left // copies)
            put(space - copies * length, (*contents, (length, copies)), full)
            left -= full * copies
            if full < number:
                if left:
                    put(space - left * length, (*contents, (length, left)), 1)
                    full, left = full + 1, 0
                if contents:
                    put(space, contents, number - full)
    return [(list(contents), number) for groups in open_.values() for contents, number in groups]


def packing_plan(counts: np.ndarray, limit: int) -> np.ndarray:
    """Places for the pieces of each length: rows (length, first number, copies, first sequence, offset).

    The k-th piece (from 0) of a length belongs to the last row of its length whose first number is at most k;
    with q = k - first number it goes to sequence first + q // copies, at offset + q % copies * length. The size
    depends on ``limit`` only.
    """
    rest = counts.astype(np.int64).copy()
    plan: list[tuple[list[tuple[int, int]], int]] = []
    if rest.sum():
        rows = patterns(rest, limit)
        x = fit_repeats(rows, rest.astype(float)) if len(rows) else np.empty(0)
        wanted = np.floor(x + 1e-9).astype(np.int64)
        # Whole repeats first, then one more of those with the largest fractions, as far as pieces are there.
        for order, most in ((np.argsort(-wanted, kind="stable"), wanted), (np.argsort(wanted - x, kind="stable"), (x - wanted > 0.5).astype(int))):
            for p in order:
                if not most[p]:
                    continue
                lengths, copies = np.unique(rows[p][rows[p] > 0], return_counts=True)
                number = min(int(most[p]), int((rest[lengths] // copies).min()))
                if number:
                    rest[lengths] -= number * copies
                    plan.append((list(zip(lengths.tolist()[::-1], copies.tolist()[::-1], strict=True)), number))
        plan += best_fit(rest, limit)
    out, numbered, sequence = [], np.zeros(limit + 1, np.int64), 0
    for contents, number in plan:
        offset = 0
        for length, copies in contents:
            out.append((length, numbered[length], copies, sequence, offset))
            numbered[length] += number * copies
            offset += length * copies
        sequence += number
    if (numbered[1:] != counts[1:]).any():
        raise AssertionError("the plan does not hold every piece once")
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def place_pieces(pieces: DataFrame, limit: int = 2048) -> DataFrame:
    """Adds ``sequence_id, offset`` to pieces (``doc_id, piece, start, length, ids_crc32``) read from a written table."""
    spark = pieces.sparkSession
    pieces = stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(limit + 1, np.int64)
    for row in histogram.collect():  # limit rows at most
        counts[row["length"]] = row["n"]
    plan = spark.sparkContext.broadcast(packing_plan(counts, limit))

    buckets = spark.createDataFrame(
        [(int(n), int(-(-counts[n] // ROWS_PER_BUCKET))) for n in np.flatnonzero(counts)], "length long, buckets long"
    )
    dealt = pieces.join(F.broadcast(buckets), "length").withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.col("buckets")))
    before = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = before.select(
        "length", "_bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("n")).alias("_before")
    )
    place = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_row"))
    numbered = dealt.withColumn("_place", place).join(before, ["length", "_bucket"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_place") - 1).alias("number"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = plan.value
        keys = (rows[:, 0] << 48) + rows[:, 1]
        for batch in batches:
            length, number = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = rows[np.searchsorted(keys, (length << 48) + number, side="right") - 1]
            place = number - at[:, 1]
            found = [pa.array(at[:, 3] + place // at[:, 2]), pa.array(at[:, 4] + place % at[:, 2] * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *found], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return numbered.mapInArrow(look_up, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, limit: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece of every document: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Every id of every document lies in exactly one piece; a sequence holds at most ``limit`` ids without gaps.
    See ``token_pieces`` for null and repeated rows. An empty table gives no rows.
    """
    return place_pieces(token_pieces(docs, tokenizer, ranks, limit, end_id, id_col, text_col), limit)
