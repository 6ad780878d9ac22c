"""Fill-in-middle over seekable compressed texts.

A text is stored as frames, each compressed on its own with zstandard, with the number of characters up to the
end of every frame. A cut is found by these numbers and only the frame that holds it is decompressed and written
as two; all other frames of the text go into the rearranged text as they are. Digests read the frames in order,
one at a time, so that no more than a frame of a text is ever in memory beside its compressed form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import documents

UNITS = 1 << 15  # characters in a frame
LEVEL = 3
BATCH_BYTES = 1 << 24  # of compressed texts that a task hands on at a time
STORED = "doc_id long, n long, ends array<long>, frames array<binary>"
_STORED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ends", pa.list_(pa.int64())), ("frames", pa.list_(pa.binary()))])


@dataclass(frozen=True)
class MiddleSpec:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    percent: int = 90  # of the texts that are rearranged, if they hold no sentinel
    suffix_first: int = 20  # percent of those with the suffix in front

    @property
    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


@lru_cache(maxsize=4)
def _compressor(level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level, write_content_size=True)


@lru_cache(maxsize=1)
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _starts(data: bytes) -> np.ndarray:
    """Where the characters of a UTF-8 text begin."""
    return np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)


class Frames:
    """A text in frames: ``ends[i]`` characters up to the end of frame i."""

    def __init__(self, ends: Sequence[int], frames: Sequence[bytes]):
        self.ends, self.frames = ends, frames

    @classmethod
    def of(cls, data: bytes, units: int = UNITS, level: int = LEVEL) -> Frames:
        """Cuts a UTF-8 text behind every ``units`` characters; an empty text has no frame."""
        if len(data) <= units:  # no more characters than bytes
            count = len(data) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))
            return cls([count], [_compressor(level).compress(data)]) if data else cls([], [])
        begins = _starts(data)
        cuts = [*begins[::units].tolist(), len(data)]
        view = memoryview(data)
        frames = [_compressor(level).compress(view[a:b]) for a, b in zip(cuts, cuts[1:])]
        return cls([min(units * (i + 1), len(begins)) for i in range(len(frames))], frames)

    @classmethod
    def joined(cls, parts: Sequence[Frames]) -> Frames:
        """The parts one after another; none of their frames is touched."""
        ends, frames, before = [], [], 0
        for part in parts:
            ends += [before + e for e in part.ends]
            frames += part.frames
            before += len(part)
        return cls(ends, frames)

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def text(self, frame: int) -> bytes:
        return _decompressor().decompress(self.frames[frame])

    def stream(self) -> Iterator[bytes]:
        """The text, frame by frame."""
        for frame in range(len(self.frames)):
            yield self.text(frame)

    def range(self, start: int, stop: int, level: int = LEVEL) -> Frames:
        """The characters from ``start`` up to ``stop``: whole frames as they are, at most two cut ones compressed anew."""
        start, stop = max(0, start), min(stop, len(self))
        ends, frames = [], []
        if start >= stop:
            return Frames(ends, frames)
        first = int(np.searchsorted(self.ends, start, side="right"))
        for frame in range(first, len(self.frames)):
            low = int(self.ends[frame - 1]) if frame else 0
            if low >= stop:
                break
            high = int(self.ends[frame])
            if start <= low and high <= stop:
                ends.append(high - start)
                frames.append(self.frames[frame])
                continue
            data = self.text(frame)
            begins = np.append(_starts(data), len(data))
            piece = data[begins[max(start, low) - low] : begins[min(stop, high) - low]]
            if piece:
                ends.append(min(stop, high) - start)
                frames.append(_compressor(level).compress(piece))
        return Frames(ends, frames)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for data in self.stream():
            digest.update(data)
        return digest.hexdigest()

    def places(self, words: Sequence[str]) -> dict[str, int]:
        """Character at which each word that occurs is found first, also across frames."""
        wanted = {w: w.encode() for w in words}
        keep = max((len(b) for b in wanted.values()), default=1) - 1
        found: dict[str, int] = {}
        tail, before = b"", 0  # bytes kept from the frames before, and the characters in front of them
        for data in self.stream():
            seen = tail + data
            for word, raw in wanted.items():
                at = seen.find(raw) if word not in found else -1
                if at >= 0:
                    found[word] = before + len(_starts(seen[:at]))
            cut = max(0, len(seen) - keep)
            before += len(_starts(seen[:cut]))  # a character counts where it begins
            tail = seen[cut:]
        return found


def arranged(text: Frames, form: str, prefix: int, middle: int, spec: MiddleSpec, level: int = LEVEL) -> Frames:
    """The text in one of the forms ``plain``, ``psm`` and ``spm``; ``prefix`` and ``middle`` in characters."""
    if form == "plain":
        return text
    marks = [Frames.of(s.encode(), level=level) for s in spec.sentinels]
    parts = [text.range(0, prefix, level), text.range(prefix + middle, len(text), level), text.range(prefix, prefix + middle, level)]
    order = (0, 1, 2) if form == "psm" else (1, 0, 2)
    return Frames.joined([x for i in order for x in (marks[i], parts[i])])


def restored(output: Frames, form: str, spec: MiddleSpec) -> Frames:
    """The text again, from what ``arranged`` made and its form alone."""
    if form == "plain":
        return output
    at = output.places(spec.sentinels)
    begins = sorted((at[s], s) for s in spec.sentinels)
    stops = [b for b, _ in begins[1:]] + [len(output)]
    parts = {s: output.range(b + len(s), stop) for (b, s), stop in zip(begins, stops, strict=True)}
    return Frames.joined([parts[spec.prefix], parts[spec.middle], parts[spec.suffix]])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Frames]]:
    for batch in batches:
        ends, frames = batch.column("ends"), batch.column("frames")
        for row in range(len(batch)):
            yield batch, row, Frames(ends[row].as_py(), frames[row].as_py())


def _batches(rows: Iterator[tuple[dict, Frames]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of rows with ``ends`` and ``frames``, none of much more than ``BATCH_BYTES`` and a single text."""
    held: list[dict] = []
    size = 0
    for values, text in rows:
        bytes_here = sum(map(len, text.frames))
        if held and (size + bytes_here > BATCH_BYTES or len(held) >= 4096):
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
        held.append({**values, "ends": text.ends, "frames": text.frames})
        size += bytes_here
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def store(docs: DataFrame, units: int = UNITS, level: int = LEVEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, ends, frames`` for every row: its characters, and its text in frames of ``units`` characters.

    A null text is an empty one, without frames. Write it to keep it; rows are independent of each other.
    """
    if units < 1:
        raise ValueError(f"a frame has at least one character, got {units}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1)
                for row in range(len(batch)):
                    text = Frames.of(texts[row].as_buffer().to_pybytes(), units, level)
                    yield {"doc_id": ids[row].as_py(), "n": len(text)}, text

        yield from _batches(rows(), _STORED)

    return documents(docs, id_col, text_col).mapInArrow(work, STORED)


def read_range(stored: DataFrame, start: Column, stop: Column) -> DataFrame:
    """``doc_id, part``: the characters from ``start`` up to ``stop`` of each stored text; only cut frames are opened before."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs = batch.column("start").to_pylist(), batch.column("stop").to_pylist()
            parts = [b"".join(t.range(lows[r], highs[r]).stream()).decode() for _, r, t in _rows([batch])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(parts, pa.string())], names=["doc_id", "part"])

    asked = stored.select("doc_id", "ends", "frames", start.cast("long").alias("start"), stop.cast("long").alias("stop"))
    return asked.mapInArrow(work, "doc_id long, part string")


def cuts(stored: DataFrame, spec: MiddleSpec = MiddleSpec()) -> DataFrame:
    """Adds ``low, high`` (the cuts, in characters), ``chosen`` and ``spm``: fixed by a digest of the id alone.

    A row without an id takes the digest of an empty id. A text with a sentinel stays as it is whatever is chosen.
    """
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    ends = [h[i] % (F.col("n") + 1) for i in range(2)]
    return stored.select(
        "*", F.least(*ends).alias("low"), F.greatest(*ends).alias("high"), (h[2] % 100 < spec.percent).alias("chosen"), (h[3] % 100 < spec.suffix_first).alias("spm")
    )


def fill_in_middle(stored: DataFrame, spec: MiddleSpec = MiddleSpec(), level: int = LEVEL) -> DataFrame:
    """Every stored text rearranged: ``doc_id, n, form, prefix_chars, middle_chars, ends, frames`` (of the output).

    Forms: ``psm`` is prefix, suffix, middle, each behind its sentinel; ``spm`` has the suffix first; ``plain`` is the
    text itself, with null lengths, if it is empty, holds a sentinel or was not chosen. Rows with equal ids have equal
    digests, and equal rows equal results.
    """
    kinds = "doc_id long, n long, form string, prefix_chars long, middle_chars long, ends array<long>, frames array<binary>"
    schema = pa.schema(
        [
            *[(c, pa.int64()) for c in ("doc_id", "n")],
            ("form", pa.string()),
            *[(c, pa.int64()) for c in ("prefix_chars", "middle_chars")],
            *[_STORED.field(c) for c in ("ends", "frames")],
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch, row, text in _rows(batches):
                n, low, high, chosen, spm = (batch.column(c)[row].as_py() for c in ("n", "low", "high", "chosen", "spm"))
                form = "spm" if spm else "psm"
                if not n or not chosen or text.places(spec.sentinels):
                    form, low, high = "plain", None, None
                made = arranged(text, form, low or 0, (high or 0) - (low or 0), spec, level)
                lengths = {"prefix_chars": low, "middle_chars": None if low is None else high - low}
                yield {"doc_id": batch.column("doc_id")[row].as_py(), "n": n, "form": form, **lengths}, made

        yield from _batches(rows(), schema)

    return cuts(stored, spec).mapInArrow(work, kinds)


def digests(outputs: DataFrame, spec: MiddleSpec = MiddleSpec()) -> DataFrame:
    """The columns of ``fill_in_middle`` without the frames, with ``output_sha256`` and ``restored_sha256`` of the texts.

    The second one is that of the text rebuilt from the output and its form.
    """
    kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    kinds = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column("form").to_pylist()
            out, back = [], []
            for _, row, text in _rows([batch]):
                out.append(text.sha256())
                back.append(out[-1] if forms[row] == "plain" else restored(text, forms[row], spec).sha256())
            columns = [batch.column(c) for c in kept] + [pa.array(x, pa.string()) for x in (out, back)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "output_sha256", "restored_sha256"])

    return outputs.mapInArrow(work, kinds)
