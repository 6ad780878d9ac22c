"""Text cut into chunks that a tokenizer never joins, and a bounded table of the ids of distinct chunks.

A byte-level BPE with the usual pattern starts a new pre-token at every space that a visible character
follows, and a SentencePiece BPE whose pieces hold the whitespace marker only at their beginning starts a
new piece at every run of spaces. So the ids of a text are the ids of its chunks, one after another, and a
chunk that comes again need not be segmented again.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np

from .blocks import BASES, LONG_WORD, Block, span_hashes

SPACE = 0x20
TABLE_ENTRIES = 1 << 21
# Bytes that may follow the space at which a chunk starts: visible ASCII, and first bytes of characters of
# which none is white space (that is all but the blocks of U+0085, U+00A0, U+1680, U+2000.. and U+3000).
VISIBLE = np.zeros(256, bool)
VISIBLE[0x21:0x7F] = VISIBLE[0xC3:0xF5] = True
VISIBLE[[0xE1, 0xE2, 0xE3]] = False

Segment = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class ChunkTable:
    """Ids of distinct chunks, found by two independent hashes; open addressing in numpy arrays.

    It holds ``entries`` chunks at most; when it is full it starts anew. What it holds changes the speed, never
    the result.
    """

    def __init__(self, segment: Segment, entries: int = TABLE_ENTRIES):
        self.segment, self.entries = segment, entries
        self.mask = (1 << (2 * entries - 1).bit_length()) - 1
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(self.mask + 1, -1, np.int32)
        self.keys = np.zeros(self.entries, np.uint64)
        self.checks = np.zeros(self.entries, np.uint64)
        self.begins = np.zeros(self.entries, np.int64)
        self.counts = np.zeros(self.entries, np.int32)
        self.pool = np.zeros(4 * self.entries, np.int32)
        self.used = self.filled = 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Entry of each chunk, -1 where it is not in the table."""
        found = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        slots = (keys & np.uint64(self.mask)).astype(np.int64)
        while len(rest):
            entry = self.slots[slots]
            here = (entry >= 0) & (self.keys[entry] == keys[rest]) & (self.checks[entry] == checks[rest])
            found[rest[here]] = entry[here]
            on = (entry >= 0) & ~here
            rest, slots = rest[on], (slots[on] + 1) & self.mask
        return found

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Puts chunks that it does not hold, distinct ones, into the table; returns their entries."""
        new = np.arange(self.used, self.used + len(keys))
        begins = np.cumsum(counts) - counts
        self.keys[new], self.checks[new], self.begins[new], self.counts[new] = keys, checks, begins + self.filled, counts
        if self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.int32)])
        self.pool[self.filled : self.filled + len(ids)] = ids
        self.filled += len(ids)
        self.used += len(keys)
        rest, slots = new, (keys & np.uint64(self.mask)).astype(np.int64)
        while len(rest):
            free = self.slots[slots] < 0
            self.slots[slots[free]] = rest[free]
            on = self.slots[slots] != rest
            rest, slots = rest[on], (slots[on] + 1) & self.mask
        return new

    def entries_of(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each chunk: where its ids are (begin, count) in the returned pool of ids."""
        keys, checks = span_hashes(data, begins, lengths, BASES)
        entry = self.find(keys, checks)
        missing = np.flatnonzero(entry < 0)
        extra: list[np.ndarray] = []
        begin, count = self.begins[entry], self.counts[entry]
        pool = self.pool
        if len(missing):
            # Distinct by key and check; a long word's hashes are not trusted.
            order = missing[np.lexsort((checks[missing], keys[missing]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (keys[order[1:]] != keys[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]])
            long = lengths[order] > LONG_WORD
            fresh |= long
            one = order[fresh]
            ids, counts = self.segment([data[b : b + n].tobytes() for b, n in zip(begins[one].tolist(), lengths[one].tolist(), strict=True)])
            starts = np.cumsum(counts) - counts
            which = np.cumsum(fresh) - 1
            begin[order], count[order] = len(pool) + starts[which], counts[which]
            extra.append(ids)
            keep = ~long[fresh]
            if self.used + int(keep.sum()) > self.entries:
                self.clear()
            if keep.sum() <= self.entries:
                each = np.repeat(keep, counts)
                self.add(keys[one][keep], checks[one][keep], ids[each], counts[keep])
        return begin, count, np.concatenate([pool, *extra]) if extra else pool


def gather(pool: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs ``pool[begin[i]:begin[i] + count[i]]``, one after another."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.arange(total) + np.repeat(begin - (ends - count), count)]


def row_sums(values: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(rows, values, count).astype(np.int64)


def rows_with(block: Block, *words: bytes) -> list[int]:
    """Rows that hold one of the strings."""
    raw, rows = block.data.tobytes(), set()
    for word in words:
        at = raw.find(word)
        while at >= 0:
            rows.add(int(np.searchsorted(block.starts, at, side="right")) - 1)
            at = raw.find(word, at + 1)
    return sorted(rows)


class ByteBpe:
    """The ids of a byte-level BPE tokenizer file, chunk by chunk.

    ``ranks`` may name the same vocabulary in rank form; its merges are the same and run several times faster.
    Texts that hold an added token's string go to the tokenizer as a whole.
    """

    def __init__(self, path: str, ranks: str | None = None, entries: int = TABLE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.ranked = self._ranked(ranks) if ranks else None
        self.table = ChunkTable(self._segment, entries)

    @staticmethod
    def _ranked(path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _segment(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [c.decode() for c in chunks]
        if self.ranked:
            ids = [self.ranked.encode_ordinary(t) for t in texts]
        else:
            ids = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), counts

    def _chunks(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
        data, starts = block.data, block.starts
        opens = np.zeros(len(data), bool)
        opens[:-1] = (data[:-1] == SPACE) & VISIBLE[data[1:]]
        # The last byte of a row has no follower of its own.
        edges = starts[1:]
        opens[edges[(edges > 0)] - 1] = False
        opens[starts[:-1][np.diff(starts) > 0]] = True
        begins = np.flatnonzero(opens)
        lengths = np.diff(np.append(begins, len(data)))
        rows = np.searchsorted(starts, begins, side="right") - 1
        begin, count, pool = self.table.entries_of(data, begins, lengths)
        return rows, begin, count, pool, rows_with(block, *self.special)

    def _by_row(self, block: Block, marked: list[int]) -> dict[int, np.ndarray]:
        return {r: np.array(self.whole.encode(block.raw(r).decode(), add_special_tokens=False).ids, np.int32) for r in marked}

    def counts(self, block: Block) -> np.ndarray:
        """Number of ids of each row."""
        rows, _, count, _, marked = self._chunks(block)
        out = row_sums(count, rows, len(block))
        for row, ids in self._by_row(block, marked).items():
            out[row] = len(ids)
        return out

    def encode(self, block: Block) -> list[np.ndarray]:
        """The ids of each row."""
        rows, begin, count, pool, marked = self._chunks(block)
        flat = gather(pool, begin, count)
        out = np.split(flat, np.cumsum(row_sums(count, rows, len(block)))[:-1])
        for row, ids in self._by_row(block, marked).items():
            out[row] = ids
        return out


@lru_cache(maxsize=2)
def byte_bpe(path: str, ranks: str | None = None) -> ByteBpe:
    """One encoder for each worker process, so that its table serves all tasks that the process runs."""
    return ByteBpe(path, ranks)


def file_digest(path: str) -> str:
    """Names a tokenizer version: the SHA-256 of its file."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()
