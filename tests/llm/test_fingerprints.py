"""Operator 11 against plain Python: votes, order of the documents, search, edges."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from larder.llm import fingerprints
from larder.llm.tables import ready

from .conftest import EDGES, by_row

FULL = (1 << 64) - 1


def plain_simhash(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    if not words:
        return 0, 0
    pairs = list(zip(["", *words], [*words, ""]))
    sums, total = [0] * 128, 0
    for a, b in pairs:
        w = 1 + (len(a) > 3) + (len(b) > 3)
        x, y = (s.encode() for s in (a, b))
        h0 = xxhash.xxh64_intdigest(y, xxhash.xxh64_intdigest(x, 42))
        h1 = xxhash.xxh64_intdigest(x, xxhash.xxh64_intdigest((1).to_bytes(4, "little"), xxhash.xxh64_intdigest(y, 42)))
        total += w
        for k in range(64):
            sums[k] += w * (h0 >> k & 1)
            sums[64 + k] += w * (h1 >> k & 1)
    return tuple(sum(1 << k for k in range(64) if 2 * sums[64 * half + k] > total) for half in range(2))


def as_hex(found):
    return f"{found[0]:016x}{found[1]:016x}"


def plain_order(rows):
    """Rows (id, text) by descending id, those without one last; equal ids by the hash of their texts."""

    def key(row):
        fine = xxhash.xxh64_intdigest(row[1].encode(), 42)
        fine -= (fine >> 63) << 64
        return row[0] is None, -(row[0] or 0), -(fine % (1 << 30)), row[1]

    return sorted(((i, t or "") for i, t in rows), key=key)


def plain_edit(text, other):
    cut = len(text) // 3
    return text[: len(text) - cut] + other[:cut]


def brute(rows, radius=3):
    order = plain_order(rows)
    prints = [plain_simhash(t) for _, t in order]
    out = []
    for k, (i, text) in enumerate(order):
        after = (k + 1) % len(order)
        changed = plain_edit(text, order[after][1])

        def near(a, b):
            return sum((x ^ y).bit_count() for x, y in zip(a, b))

        within = sum(near(prints[k], p) <= radius for p in prints) - 1 if i is not None and i % 100 == 0 else None
        own = plain_simhash(changed)
        out.append(
            (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), as_hex(prints[k]), as_hex(own), 1 - near(prints[k], own) / 128,
             1 - near(prints[k], prints[after]) / 128, within)
        )
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_within")


@pytest.mark.parametrize("rows_each", [4096, 3])
def test_query_equals_brute_force(spark, small, monkeypatch, rows_each):
    monkeypatch.setattr(fingerprints, "ROWS", rows_each)
    ready(spark)
    docs = spark.read.parquet(f"{small}/documents.parquet").filter("n_chars < 1500")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()][:90]
    rng = random.Random(2)
    base = "eins zwei drei vier fünf sechs sieben acht neun zehn".split() * 3
    rows += [(100 * k, " ".join([*base, *rng.choices(base, k=k % 3)])) for k in range(20, 32)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert by_row(fingerprints.document_fingerprints(df, F.col("doc_id") % 100 == 0), *COLUMNS) == brute(rows)


@pytest.mark.parametrize("rows_each", [4096, 2])
def test_edges(spark, edges, nothing, monkeypatch, rows_each):
    monkeypatch.setattr(fingerprints, "ROWS", rows_each)
    rows = [r[:2] for r in EDGES]
    assert by_row(fingerprints.document_fingerprints(edges, F.col("doc_id") % 100 == 0), *COLUMNS) == brute(rows)
    assert fingerprints.document_fingerprints(nothing).count() == 0
    for one in ([(7, "only one text")], [(None, None)]):
        df = spark.createDataFrame(one, "doc_id long, text string")
        assert by_row(fingerprints.document_fingerprints(df, F.col("doc_id") % 100 == 0), *COLUMNS) == brute(one)


def test_a_hot_id_is_spread_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS", 10)
    ready(spark)
    rows = [(5 if k % 3 else k, f"text number {k}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = fingerprints.with_next(df)
    sizes = [r["count"] for r in found.groupBy(F.shiftright("row", 40)).count().collect()]
    assert max(sizes) <= 40
    order = plain_order(rows)
    expected = [(*a, b[1]) for a, b in zip(order, order[1:] + order[:1])]
    assert by_row(found, "doc_id", "text", "next_text") == sorted(expected)


@pytest.mark.parametrize("radius, blocks, longest", [(3, 4, 1024), (3, 5, 4), (0, 1, 2), (6, 8, 1024)])
def test_search_finds_all_within_the_radius(spark, radius, blocks, longest):
    ready(spark)
    rng = random.Random(radius)
    prints = {(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(40)}
    for hi, lo in list(prints)[:10]:
        for _ in range(12):
            for _ in range(rng.randint(0, 5)):
                hi, lo = hi ^ (1 << rng.randrange(64)) * rng.randint(0, 1), lo ^ (1 << rng.randrange(64)) * rng.randint(0, 1)
            prints.add((hi, lo))
    prints = sorted(prints)

    def signed(x):
        return x - ((x >> 63) << 64)

    df = spark.createDataFrame([(signed(a), signed(b), 1) for a, b in prints], "hi long, lo long, n long")
    asked = prints[::3]
    found = fingerprints.search(df, spark.createDataFrame([(signed(a), signed(b)) for a, b in asked], "hi long, lo long"), radius, blocks, longest)
    got = sorted((r["hi"] & FULL, r["lo"] & FULL, x["hi"] & FULL, x["lo"] & FULL) for r in found.collect() for x in r["found"])
    near = [(*q, *p) for q in asked for p in prints if (q[0] ^ p[0]).bit_count() + (q[1] ^ p[1]).bit_count() <= radius]
    assert got == sorted(near)
    with pytest.raises(ValueError):
        fingerprints.block_tables(df, 3, 3)


def test_edited_texts_stay_near_and_no_python_runs(spark, small):
    df = fingerprints.document_fingerprints(ready(spark).read.parquet(f"{small}/documents.parquet"))
    rows = df.collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.95 * len(rows)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
