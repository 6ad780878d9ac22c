"""Operators 3, 9 and 10 against the tokenizer libraries."""

import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer

from larder.llm import packing, pieces, tokencache
from larder.llm.blocks import text_blocks
from larder.llm.chunks import ByteBpe
from larder.llm.tables import documents, read, ready
from larder.session import fresh_folder

from .conftest import EDGES, by_row

BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "   z", "a  b", "a   b", " \n x", "foo \n  bar", "tail  ", "tail \n", "\n\n a \n", "it's  we'll \t\t x", "x<|endoftext|> a",
    "<|endoftext|>", "é è   x 　y", "漢字 かな  x", "a" * 2000 + " " + "b" * 700, "\x1c x\x1f y \x85z", "▁ a ▁▁b", "▁", "\U0001f600 \U0001f600", "\x00 a\x00",
]


@pytest.mark.parametrize("ranks", [None, RANKS])
@pytest.mark.parametrize("entries", [4, 1 << 12])
def test_chunked_ids_equal_the_tokenizers(ranks, entries):
    own = ByteBpe(BPE, ranks, entries)
    found, counts = [], []
    for _ in range(2):  # the second time from the table
        found, counts = [], []
        for _, block in text_blocks(pa.array(ODD), 64):
            found += [x.tolist() for x in own.encode(block)]
            counts += own.counts(block).tolist()
    library = Tokenizer.from_file(BPE)
    assert found == [library.encode(t, add_special_tokens=False).ids for t in ODD]
    assert counts == [len(x) for x in found]


def test_pieces_equal_the_library(spark, edges, nothing):
    more = spark.createDataFrame([(100 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    docs = edges.select("doc_id", "text").union(more)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = []
    for doc_id, text in [(r[0], r[1]) for r in EDGES] + [(100 + k, t) for k, t in enumerate(ODD)]:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((doc_id, len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    for head in (3, 1 << 12):  # the broadcast table holds hardly any chunk, or all
        got = pieces.round_trip(docs, PIECES, ("n_tokens", "ids_sha256", "decoded_sha256"), head)
        assert by_row(got, *got.columns) == sorted(expected, key=lambda r: [(x is not None, x) for x in r])
    real = pieces.round_trip(docs, PIECES).filter("doc_id = 7").first()
    assert real["ids"] == library.encode(EDGES[-2][1], add_bos=True, add_eos=True) and real["decoded"] == library.decode(real["ids"])
    assert pieces.round_trip(nothing, PIECES).count() == 0


def test_chunk_table_stays_within_its_bound_whatever_the_counts(spark):
    ready(spark)
    text = " ".join(f"w{k}" for k in range(5)) + " "
    df = spark.createDataFrame([(1, text * (pieces.COUNTS + 10)), (2, "rare words")], "doc_id long, text string")
    for head in (0, 1, 2, 4, 5, 6, 100):
        table = pieces.chunk_table(documents(df), PIECES, head=head).collect()
        assert len(table) <= head and len({r["chunk"] for r in table}) == len(table)
        assert head < 5 or sum(r["n"] > pieces.COUNTS for r in table) >= 5


def test_chunk_table_holds_each_chunk_once_with_its_count(spark):
    docs = spark.createDataFrame([(1, "to be or not to be"), (2, "to  be"), (3, None)], "doc_id long, text string").fillna("")
    found = {bytes(r["chunk"]): r["n"] for r in pieces.chunk_counts(docs).collect()}
    assert found == {b" to": 3, b" be": 2, b"  be": 1, b" or": 1, b" not": 1}
    table = pieces.chunk_table(docs, PIECES, head=2)
    assert {bytes(r["chunk"]) for r in table.collect()} == {b" to", b" be"}


def test_models_whose_pieces_cross_are_refused():
    with pytest.raises(Exception):
        pieces.PieceModel(BPE)


def test_cache_counts_and_appends_only_misses(spark, edges, nothing):
    library = Tokenizer.from_file(BPE)
    cache = fresh_folder(spark, "cache")

    def expected(rows):
        counts = [(r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
        return sorted([(*c, c[2] > 1024) for c in counts], key=lambda r: [(x is not None, x) for x in r])

    columns = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert tokencache.token_counts(nothing, BPE, cache).count() == 0
    assert by_row(tokencache.token_counts(edges, BPE, cache), *columns) == expected(EDGES)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({r[1] or "" for r in EDGES}) == stored.select("digest").distinct().count()
    # Wrong counts planted in the cache come back: nothing that is stored is encoded again.
    name = tokencache.tokenizer_version(BPE)
    planted = fresh_folder(spark, "cache")
    stored.filter(stored.version == name).selectExpr("digest", "n_tokens + 5000 as n_tokens", "version").write.partitionBy("version").parquet(planted)
    more = edges.select("doc_id", "text").union(spark.createDataFrame([(99, "something new")], "doc_id long, text string"))
    got = {r["doc_id"]: r["n_tokens"] for r in tokencache.token_counts(more, BPE, planted).filter("doc_id in (3, 99)").collect()}
    assert got == {3: 5000, 99: len(library.encode("something new").ids)}
    assert spark.read.parquet(planted).count() == stored.count() + 1


def test_another_tokenizer_version_is_another_cache(spark, edges):
    cache = fresh_folder(spark, "cache")
    tokencache.token_counts(edges, BPE, cache).count()
    assert tokencache.read_cache(spark, cache, "other").count() == 0


def check_packing(rows, texts, limit):
    library = Tokenizer.from_file(BPE)
    sequences, found = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        found[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    expected = defaultdict(list)
    for doc_id, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % limit or limit, len(ids) + 1, limit)] if len(ids) > limit else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id].append((piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    return len(sequences), sum(r["length"] for r in rows)


@pytest.mark.parametrize("limit", [7, 2048])
def test_packing_holds_every_piece_once(spark, edges, nothing, limit):
    rows = packing.pack(edges, BPE, RANKS, limit).collect()
    number, total = check_packing(rows, [(r[0], r[1]) for r in EDGES], limit)
    assert number <= -(-total // limit) + 1
    assert packing.pack(nothing, BPE, RANKS, limit).count() == 0


def test_packing_of_the_test_documents_is_tight(spark, small):
    docs = read(ready(spark), small, "documents")
    rows = packing.pack(docs, BPE).collect()
    number, total = check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    assert number <= 1.01 * total / 2048 + 1


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_complete_and_close_to_the_bound(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(257, np.int64)
    np.add.at(counts, np.minimum(rng.geometric(0.02, 40_000), 256), 1)
    counts[rng.integers(1, 257, 30)] *= seed
    plan = packing.packing_plan(counts, 256)
    placed, used = np.zeros(257, np.int64), 0
    for length in np.unique(plan[:, 0]):
        runs = plan[plan[:, 0] == length]
        assert (np.diff(runs[:, 1]) > 0).all()
        placed[length] = counts[length]
    used = int(plan[:, 3].max()) + 1
    assert (placed == counts).all() and used >= -(-int((counts * np.arange(257)).sum()) // 256)
    assert used <= 1.02 * (counts * np.arange(257)).sum() / 256 + 2


def test_repeats_fit_a_histogram_made_of_patterns():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 30, 10, 100]] = [500, 300, 200, 200, 50]
    rows = packing.patterns(counts, 100)
    x = packing.fit_repeats(rows, counts.astype(float))
    assert (x >= 0).all()
    made = np.bincount(rows.ravel(), np.repeat(x, 3), 101)
    assert np.abs(made - counts)[1:].sum() < 0.05 * counts.sum()
