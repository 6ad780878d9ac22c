"""Operator 13: frames, ranges, forms and their way back."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from larder.llm import frames
from larder.llm.frames import Frames, MiddleSpec
from larder.llm.tables import ready

from .conftest import EDGES, by_row

TEXTS = ["", "a", "abc", "é漢\U0001f600x" * 7, "x" * 50, "ends with <", "<P", "a<S>b", "S>M>P>" * 5, "<" * 20]


def whole(text):
    return b"".join(text.stream()).decode()


@pytest.mark.parametrize("units", [1, 2, 3, 7, 1000])
def test_frames_ranges_and_places(units):
    for text in TEXTS:
        stored = Frames.of(text.encode(), units)
        assert whole(stored) == text and len(stored) == len(text)
        assert [len(stored.text(k).decode()) for k in range(len(stored.frames))] == [len(text[k : k + units]) for k in range(0, len(text), units)]
        for start in range(0, len(text) + 1, 3):
            for stop in range(0, len(text) + 2, 2):
                part = stored.range(start, stop)
                assert whole(part) == text[start:stop] and len(part) == len(text[start:stop])
        words = ["<S>", "漢", "x", "><", "M>P"]
        assert stored.places(words) == {w: text.find(w) for w in words if w in text}


def test_whole_frames_are_taken_as_they_are():
    stored = Frames.of(b"abcdefghij", 2)
    part = stored.range(1, 9)
    assert part.frames[1:-1] == stored.frames[1:4] and part.ends == [1, 3, 5, 7, 8]


@pytest.mark.parametrize("units", [1, 4, 1000])
def test_forms_and_the_way_back(units):
    spec, rng = MiddleSpec(), random.Random(units)
    for text in [t for t in TEXTS if "<S>" not in t]:
        low, high = sorted(rng.randint(0, len(text)) for _ in range(2))
        pre, mid, suf = text[:low], text[low:high], text[high:]
        stored = Frames.of(text.encode(), units)
        for form, expected in (("plain", text), ("psm", f"<P>{pre}<S>{suf}<M>{mid}"), ("spm", f"<S>{suf}<P>{pre}<M>{mid}")):
            made = frames.arranged(stored, form, low, high - low, spec)
            assert whole(made) == expected and len(made) == len(expected)
            assert whole(frames.restored(made, form, spec)) == text
            assert whole(frames.restored(Frames.of(expected.encode(), 5), form, spec)) == text


def plain(doc_id, text):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    back = hashlib.sha256(text.encode()).hexdigest()
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, back, back
    pre, mid, suf = text[:low], text[low:high], text[high:]
    form, out = ("spm", f"<S>{suf}<P>{pre}<M>{mid}") if h4 % 100 < 20 else ("psm", f"<P>{pre}<S>{suf}<M>{mid}")
    return doc_id, n, form, low, high - low, hashlib.sha256(out.encode()).hexdigest(), back


COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@pytest.mark.parametrize("units, batch_bytes", [(frames.UNITS, frames.BATCH_BYTES), (3, 100)])
def test_rows_equal_plain_python(spark, edges, nothing, monkeypatch, units, batch_bytes):
    monkeypatch.setattr(frames, "BATCH_BYTES", batch_bytes)
    rows = [*[r[:2] for r in EDGES], *[(100 + k, t) for k, t in enumerate(TEXTS * 3)], (None, "<M>")]
    if units == 3:
        rows = [(i, t) for i, t in rows if len(t or "") < 1000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted((plain(*r) for r in rows), key=lambda r: [(x is not None, x) for x in r])
    assert by_row(frames.digests(frames.fill_in_middle(frames.store(df, units))), *COLUMNS) == expected
    same = frames.digests(frames.fill_in_middle(frames.store(edges)))
    assert by_row(same, *COLUMNS) == sorted((plain(*r[:2]) for r in EDGES), key=lambda r: [(x is not None, x) for x in r])
    assert frames.digests(frames.fill_in_middle(frames.store(nothing))).collect() == []


def test_read_range(spark):
    ready(spark)
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    stored = frames.store(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    found = frames.read_range(stored, F.lit(2), F.col("n") - 1)
    assert by_row(found, "doc_id", "part") == [(k, t[2 : max(2, len(t) - 1)]) for k, t in rows]
    with pytest.raises(ValueError):
        frames.store(stored, 0)
