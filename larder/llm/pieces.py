"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece of a model has a whitespace marker after another character, its merges never cross the place
before a run of markers. So a text falls into chunks (markers and what follows up to the next marker), and its
ids are the ids of its chunks in order. Spark counts the distinct chunks of the corpus; the most frequent ones,
as many as a stated bound allows to broadcast, are segmented once and written as a table. The tasks look the
chunks of their texts up by hash and join the ids back by position. Chunks beyond the bound are rare; a task
segments each of them once for all its texts, which costs less than moving every occurrence to a table.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BASES, LONG_WORD, Block, span_hashes, text_blocks
from .chunks import SPACE, ChunkTable, gather, row_sums, rows_with
from .tables import documents, stage

MARKER = "▁"
HEAD = 1 << 18  # chunks in the broadcast table
HEAD_BYTES = 64  # of a chunk in the broadcast table; so it holds 16 MB of chunks and 64 ids for each at most
COUNTS = 1 << 12  # counts from which on chunks are not told apart when the bound is found


class PieceModel:
    """A SentencePiece BPE model whose texts fall into chunks."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        normal = spec.normalizer_spec
        plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and not normal.remove_extra_whitespaces and normal.escape_whitespaces
        crossing = any(MARKER in p.piece.lstrip(MARKER) for p in spec.pieces)
        if not plain or crossing or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("texts of this model do not fall into chunks at whitespace")
        # Strings that count as one piece wherever they stand could cross a chunk's edge.
        if any(p.type == p.USER_DEFINED and " " in p.piece.replace(MARKER, " ") for p in spec.pieces):
            raise ValueError("the model has own pieces with whitespace")
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.marker = self.model.piece_to_id(MARKER)
        self.table = ChunkTable(self.segment)
        self.seeded = ""

    def segment(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for chunks that begin with a space, which the model itself puts before a text."""
        found = self.model.encode([c[1:].decode() for c in chunks], num_threads=1)
        found = [ids if len(c) > 1 else [self.marker] for c, ids in zip(chunks, found, strict=True)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(counts.sum())), counts

    def seed(self, chunks: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        """Starts the table with known chunks."""
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        data = np.frombuffer(b"".join(chunks), np.uint8)
        self.table.clear()
        if len(chunks):
            self.table.add(*span_hashes(data, np.cumsum(lengths) - lengths, lengths, BASES), ids, counts)

    def encode(self, block: Block) -> list[np.ndarray]:
        data, begins, lengths, rows = chunk_spans(block)
        begin, count, pool = self.table.entries_of(data, begins, lengths)
        out = np.split(gather(pool, begin, count), np.cumsum(row_sums(count, rows, len(block)))[:-1])
        for row in rows_with(block, MARKER.encode()):  # the text's own markers count as spaces
            out[row] = np.array(self.model.encode(block.raw(row).decode()), np.int32)
        return out


def chunk_spans(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with a space put before each text, and the begin, length and row of their chunks."""
    sizes = np.diff(block.starts)
    full = np.flatnonzero(sizes)
    heads = block.starts[:-1][full] + np.arange(len(full))
    data = np.empty(len(block.data) + len(full), np.uint8)
    own = np.ones(len(data), bool)
    own[heads] = False
    data[heads] = SPACE
    data[own] = block.data
    opens = data == SPACE
    opens[1:] &= data[:-1] != SPACE
    opens[heads] = True
    begins = np.flatnonzero(opens)
    lengths = np.diff(np.append(begins, len(data)))
    return data, begins, lengths, full[np.searchsorted(heads, begins, side="right") - 1]


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def chunk_counts(docs: DataFrame) -> DataFrame:
    """``chunk, n``: every distinct chunk of ``docs(doc_id, text)`` and how often it occurs."""
    schema = pa.schema([("chunk", pa.binary()), ("n", pa.int64())])

    def distinct(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        keys, checks = span_hashes(data, begins, lengths, BASES)
        order = np.lexsort((checks, keys))
        keys, checks = keys[order], checks[order]
        first = np.ones(len(order), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1]) | (lengths[order][1:] > LONG_WORD)
        at = np.flatnonzero(first)
        one = order[at]
        sizes = lengths[one]
        return gather(data, begins[one], sizes), np.cumsum(sizes) - sizes, sizes, np.add.reduceat(n[order], at)

    def joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        shift = np.cumsum([0, *(len(p[0]) for p in parts[:-1])])
        moved = [(d, b + s, x, n) for (d, b, x, n), s in zip(parts, shift, strict=True)]
        return distinct(*(np.concatenate(c) for c in zip(*moved, strict=True)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            for _, block in text_blocks(batch.column(1)):
                data, begins, lengths, _ = chunk_spans(block)
                if len(begins):
                    parts.append(distinct(data, begins, lengths, np.ones(len(begins), np.int64)))
            if parts:
                data, begins, _, n = joined(parts)
                offsets = pa.py_buffer(np.append(begins, len(data)).astype(np.int32))
                chunks = pa.Array.from_buffers(pa.binary(), len(begins), [None, offsets, pa.py_buffer(data)])
                for at in range(0, len(n), 100_000):
                    yield pa.RecordBatch.from_arrays([chunks.slice(at, 100_000), pa.array(n[at : at + 100_000])], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(work, "chunk binary, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def chunk_table(docs: DataFrame, model: str, head: int = HEAD) -> DataFrame:
    """``chunk, n, ids`` of the most frequent chunks of ``docs(doc_id, text)``, ``head`` rows at most; written once."""
    counted = stage(chunk_counts(docs).filter(F.octet_length("chunk") <= HEAD_BYTES), "chunks")
    # Exact up to COUNTS, beyond it in steps of a sixteenth of a doubling: some thousand rows at any size.
    steps = F.floor(16 * F.log2(F.greatest("n", F.lit(COUNTS)) / float(COUNTS))).cast("long")
    counted = counted.withColumn("step", F.least("n", F.lit(COUNTS)) + steps)
    by_step = counted.groupBy("step").agg(F.count(F.lit(1)).alias("chunks"))
    least, total, rest = None, 0, F.lit(False)
    for step, chunks in sorted(by_step.collect(), reverse=True):
        if total + chunks > head:
            # Of the step that no longer fits a share by hash.
            rest = (F.col("step") == step) & (F.pmod(F.xxhash64("chunk"), F.lit(chunks)) < head - total)
            break
        least, total = step, total + chunks
    frequent = counted.filter((F.col("step") >= least) | rest if least is not None else rest).drop("step").limit(head)
    schema = pa.schema([("chunk", pa.binary()), ("n", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_model(model)
        for batch in batches:
            ids, counts = encoder.segment(batch.column(0).to_pylist())
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], schema=schema)

    return stage(frequent.mapInArrow(work, "chunk binary, n long, ids array<int>"), "pieces")


OUTPUTS = {
    "ids": pa.list_(pa.int32()),
    "decoded": pa.string(),
    "n_tokens": pa.int64(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}


def round_trip(
    docs: DataFrame,
    model: str,
    outputs: tuple[str, ...] = ("ids", "decoded"),
    head: int = HEAD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id`` and the wanted ``outputs`` for every row.

    ``ids`` are those of the library with begin and end id; ``decoded`` is its decoding of them; ``n_tokens``
    counts them; the digests are over the ids as little-endian 32-bit integers and over the decoded UTF-8. A
    null or empty text has the begin and end id only and decodes to the empty text.
    """
    spark = docs.sparkSession
    texts = documents(docs, id_col, text_col)
    known = chunk_table(texts, model, head).select("chunk", "ids").toArrow()
    lists = known.column("ids").combine_chunks()
    name = uuid.uuid4().hex  # tells the tasks of this run that a process has started its table from this broadcast
    start = spark.sparkContext.broadcast(
        (known.column("chunk").to_pylist(), lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64))
    )
    schema = pa.schema([("doc_id", pa.int64()), *((name, OUTPUTS[name]) for name in outputs)])
    decoding = any(name.startswith("decoded") for name in outputs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_model(model)
        if encoder.seeded != name:
            encoder.seed(*start.value)
            encoder.seeded = name
        begin, end = encoder.model.bos_id(), encoder.model.eos_id()
        for batch in batches:
            for first, block in text_blocks(batch.column(1)):
                ids = [np.concatenate([[begin], x, [end]]).astype("<u4") for x in encoder.encode(block)]
                decoded = [encoder.model.decode(x.tolist()) for x in ids] if decoding else []
                made = {
                    "ids": lambda ids=ids: [x.astype(np.int32) for x in ids],
                    "decoded": lambda decoded=decoded: decoded,
                    "n_tokens": lambda ids=ids: [len(x) for x in ids],
                    "ids_sha256": lambda ids=ids: [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
                    "decoded_sha256": lambda decoded=decoded: [hashlib.sha256(x.encode()).hexdigest() for x in decoded],
                }
                columns = [pa.array(made[name](), OUTPUTS[name]) for name in outputs]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(block)), *columns], schema=schema)

    kinds = {"ids": "array<int>", "n_tokens": "long"}
    return texts.mapInArrow(work, ", ".join(["doc_id long", *(f"{n} {kinds.get(n, 'string')}" for n in outputs)]))
