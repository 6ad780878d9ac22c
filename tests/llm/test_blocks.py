import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm.blocks import BASES, Block, span_hashes, spans, text_blocks
from larder.llm.hashed import BLANK, LETTER, grams, joined, lookup, style, words


def block(*texts):
    raw = [t.encode() for t in texts]
    return Block(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def test_blocks_cover_every_row_in_order():
    texts = ["a" * 30, None, "", "é" * 50, "b", None]
    for column in (pa.array(texts), pa.array([*texts, "x"]).slice(0, 6), pa.array(texts, pa.large_string())):
        found = []
        for first, part in text_blocks(column, 40):
            assert first == len(found)
            found += [part.raw(r).decode() for r in range(len(part))]
        assert found == [t or "" for t in texts]
    assert list(text_blocks(pa.array([], pa.string()))) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" ab\ncé9#", max_size=60), min_size=1, max_size=6))
def test_spans_are_the_runs_of_each_row(texts):
    part = block(*texts)
    begins, lengths, rows = spans(~BLANK[part.data], part.starts)
    got = [(int(r), part.data[b : b + n].tobytes()) for b, n, r in zip(begins, lengths, rows)]
    assert got == [(k, w) for k, t in enumerate(texts) for w in t.encode().split()]


def test_hashes_depend_on_the_bytes_of_the_span_alone():
    rng = np.random.default_rng(1)
    spans_ = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in [*range(1, 40), 600, 5000]] * 2
    order = rng.permutation(len(spans_))
    data = np.frombuffer(b"".join(spans_[k] for k in order), np.uint8)
    lengths = np.array([len(spans_[k]) for k in order])
    for hashes in span_hashes(data, np.cumsum(lengths) - lengths, lengths, BASES):
        by_text = {}
        for k, h in zip(order, hashes):
            by_text.setdefault(spans_[k], set()).add(int(h))
        assert all(len(v) == 1 for v in by_text.values())
        assert len({next(iter(v)) for v in by_text.values()}) == len(by_text)


def test_grams_know_words_pairs_and_skips():
    rows, features = grams(block("The cat, the dog", "", "cat THE cat"))
    hashes, word_rows = words(block("The cat, the dog", "", "cat THE cat"))
    assert word_rows.tolist() == [0, 0, 0, 0, 2, 2, 2]
    assert hashes[0] == hashes[2] == hashes[5] and hashes[1] == hashes[4] == hashes[6]
    assert np.bincount(rows, minlength=3).tolist() == [4 + 3 + 2, 0, 3 + 2 + 1]
    pairs, _ = joined(hashes, word_rows, 1, np.uint64(3))
    assert pairs[0] == pairs[4] and pairs[1] == pairs[3]  # "the cat" and "cat the" in both
    assert len(features) == len(rows)


def test_style_and_lookup():
    rows, features = style(block("AB cd!! Ef", "  ", "12 ###"))
    assert set(rows.tolist()) == {0, 2}
    at, there = lookup(np.unique(features), features)
    assert there.all() and (np.unique(features)[at] == features).all()
    assert not lookup(np.empty(0, np.int32), features)[1].any()
    assert LETTER[ord("a")] and not LETTER[ord("1")]


def test_null_with_bytes_is_refused():
    raw = pa.array(["ab", "cd"])
    odd = pa.Array.from_buffers(pa.string(), 2, [pa.py_buffer(b"\x02"), raw.buffers()[1], raw.buffers()[2]], null_count=1)
    with pytest.raises(ValueError):
        list(text_blocks(odd))
