"""Blocks of UTF-8 text inside a task: bounded slices of an Arrow column, and vectorised hashes of their words."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21  # text handled at a time; a single longer text makes a block of its own

# Words beyond this length are not told apart by their polynomial hash alone (see word_hashes).
LONG_WORD = 512
GOLD = np.uint64(0x9E3779B97F4A7C15)


class Block:
    """Consecutive rows of a text column: ``data`` holds their bytes, row i has ``data[starts[i]:starts[i + 1]]``."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        self.data, self.starts = data, starts

    def __len__(self) -> int:
        return len(self.starts) - 1

    def raw(self, row: int) -> bytes:
        return self.data[self.starts[row] : self.starts[row + 1]].tobytes()


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, Block]]:
    """Cuts a string column into blocks of about ``block_bytes``; yields the first row number and the block.

    Nulls count as empty texts. The bytes are not copied.
    """
    rows = len(column)
    if not rows:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(offsets, kind, rows + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    if column.null_count:
        # A null has no bytes of its own in Spark's Arrow batches; make sure of it for others.
        lengths = np.diff(ends)
        if lengths[np.asarray(column.is_null())].any():
            raise ValueError("a null text carries bytes")
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + block_bytes, side="right")) - 1)
        last = min(last, rows)
        yield first, Block(whole[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
        first = last


def over_texts(
    batches: Iterator[pa.RecordBatch], work: Callable[[Block], dict[str, pa.Array | np.ndarray | list]], schema: pa.Schema, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Applies ``work`` to every block of the text column and puts its columns beside the other ones."""
    for batch in batches:
        names = [n for n in batch.schema.names if n != text and n in schema.names]
        for first, block in text_blocks(batch.column(batch.schema.names.index(text))):
            made = work(block)
            kept = {n: batch.column(batch.schema.names.index(n)).slice(first, len(block)) for n in names}
            yield pa.RecordBatch.from_arrays(
                [kept[f.name] if f.name in kept else pa.array(made[f.name], f.type) for f in schema], schema=schema
            )


@lru_cache(maxsize=4)
def _powers(base: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.full(count, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the information of 64-bit hashes over all their bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


BASES = (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)
SHORT = 16  # bytes; most words are shorter


def span_hashes(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, bases: tuple[int, ...] = BASES[:1]) -> list[np.ndarray]:
    """64-bit polynomial hashes of each span ``data[begins[i]:begins[i] + lengths[i]]``, one for each base.

    A span of at most ``SHORT`` bytes adds its bytes place by place, all spans at once; longer ones are summed apart.
    """
    out = [np.zeros(len(begins), np.uint64) for _ in bases]
    if not len(begins):
        return out
    last = len(data) - 1
    with np.errstate(over="ignore"):
        near = np.minimum(lengths, SHORT)
        tables = [_powers(base, SHORT) for base in bases]
        order = np.argsort(-near.astype(np.int8), kind="stable")
        at, sizes = begins[order], near[order]
        sums = [np.zeros(len(begins), np.uint64) for _ in bases]
        live = np.searchsorted(-sizes, -np.arange(1, SHORT + 1), side="right")
        for place in range(SHORT):
            n = int(live[place])
            if not n:
                break
            values = data[np.minimum(at[:n] + place, last)].astype(np.uint64) + np.uint64(1)
            for total, powers in zip(sums, tables, strict=True):
                total[:n] += values * powers[place]
        for hashes, total in zip(out, sums, strict=True):
            hashes[order] = total
        long = np.flatnonzero(lengths > SHORT)
        if len(long):
            rest = lengths[long] - SHORT
            starts = np.cumsum(rest) - rest
            place = np.arange(int(rest.sum()), dtype=np.int64) - np.repeat(starts, rest)
            values = data[place + np.repeat(begins[long] + SHORT, rest)].astype(np.uint64) + np.uint64(1)
            for hashes, base in zip(out, bases, strict=True):
                powers = _powers(base, 1 << int(place.max() + 1 + SHORT).bit_length())
                hashes[long] += np.add.reduceat(values * powers[place + SHORT], starts)
        size = lengths.astype(np.uint64)
        return [mix(h + size) for h in out]


def spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that do not cross a row start: their begins, lengths and row numbers."""
    if not len(inside):
        return (np.empty(0, np.int64),) * 3
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = starts[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    begins = np.flatnonzero(opens)
    return begins, np.flatnonzero(closes) - begins + 1, np.searchsorted(starts, begins, side="right") - 1
