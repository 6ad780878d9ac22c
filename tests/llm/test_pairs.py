"""Operators 5 and 8 and the components they share, against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from larder.llm import projections, simhash
from larder.llm.graph import components
from larder.llm.tables import ready

from .conftest import EDGES, by_row


def unite(nodes, links):
    least = {n: n for n in nodes}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(5, 5), (300, 301), (301, 300)]
    links += [(rng.randrange(400, 480), rng.randrange(400, 480)) for _ in range(50)]
    df = spark.createDataFrame([*links, (None, 4), (4, None)], "a long, b long")
    real = [(a, b) for a, b in links if a != b]
    expected = unite({x for link in real for x in link}, real)
    assert dict((r["node"], r["component"]) for r in components(df).collect()) == expected
    assert components(df).count() == len(expected)
    assert components(df.filter("false")).count() == 0


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_the_hash_of_spark(spark):
    for text in [*[r[1] or "" for r in EDGES if r[1] is None or len(r[1]) < 1000], "É é ÀB a\x0bb\x1cc", "one", "one two"]:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def brute(rows):
    """Component of each row from ids and fingerprints; rows without an id follow their fingerprint."""
    nodes = {i for i, _ in rows if i is not None}
    known = [(i, f) for i, f in rows if i is not None]
    links = [(a, b) for k, (a, f) in enumerate(known) for b, g in known[:k] if (f ^ g).bit_count() <= 2]
    least = unite(nodes, links)
    by_print = {}
    for i, f in known:
        by_print[f] = min(by_print.get(f, least[i]), least[i])
    return sorted([(i, f"{f:016x}", least[i] if i is not None else by_print.get(f)) for i, f in rows], key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("bucket", [1, 64])
def test_links_of_planted_fingerprints(spark, bucket):
    """Fingerprints in chains and balls of one, two and three bits, with hot halves; by pairs or by shared neighbours."""
    rng = random.Random(5)
    prints = [0, 1, 3, 7, 15, 2**64 - 1, 2**63, 2**63 + 2**31, 2**32, 2**32 + 2**33]
    for _ in range(40):
        f = rng.getrandbits(64)
        prints.append(f)
        for flips in (1, 2, 3):
            g = f
            for bit in rng.sample(range(64), flips):
                g ^= 1 << bit
            prints.append(g)
    hot = rng.getrandbits(32) << 32
    prints += [hot | rng.getrandbits(32) & 0xFFF for _ in range(60)]
    prints = list(dict.fromkeys(prints))
    signed = [(f - 2**64 if f >= 2**63 else f, k) for k, f in enumerate(prints)]
    classes = spark.createDataFrame(signed, "fp long, rep long")
    found = components(simhash.close_fingerprints(classes, bucket))
    expected = {i: c for i, _, c in brute([(k, f) for k, f in enumerate(prints)])}
    got = {r["node"]: r["component"] for r in found.collect()}
    assert {k: got.get(k, k) for k in expected} == expected


def test_simhash_components_on_edges(spark, edges, nothing):
    got = simhash.simhash_components(edges)
    assert by_row(got, "doc_id", "fingerprint", "component_id") == brute([(r[0], plain_fingerprint(r[1])) for r in EDGES])
    assert simhash.simhash_components(nothing).count() == 0


def vectors(seed=2, groups=12):
    rng = np.random.default_rng(seed)
    rows, number = [], 0
    for group in range(groups):
        centre = rng.standard_normal(16)
        for noise in (0.0, 0.0, 0.05, 0.1, 0.2, 0.3):
            rows.append((number, (centre + noise * rng.standard_normal(16)).astype(np.float32).tolist(), group % 3))
            number += 1
    rows += [(number + k, rng.standard_normal(16).astype(np.float32).tolist(), k % 3) for k in range(100)]
    return rows


def check_vectors(got, rows, threshold=0.93):
    units = {i: np.array(v, float) / np.linalg.norm(v) for i, v, _ in rows}
    labels = {i: label for i, _, label in rows}
    links = [(a, b) for a in units for b in units if a < b and labels[a] == labels[b] and units[a] @ units[b] >= threshold]
    least = unite(units, links)
    number = dict.fromkeys(units, 0)
    for a, b in links:
        number[a] += 1
        number[b] += 1
    assert got == sorted((i, number[i], least[i], least[i] == i) for i in units)


def test_near_vectors_equal_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = projections.near_vectors(df)
    check_vectors(by_row(got, "vec_id", "n_links", "component_id", "kept"), rows)


def test_vectors_that_cannot_link(spark):
    ready(spark)
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [1.0, None], 1),
        (8, [float("nan"), 1.0], 1), (9, [float("inf"), 1.0], 1), (None, [1.0, 0.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (12, [0.0, 1.0], 1), (12, [0.0, 1.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"rep": F.lit(1), "vector": F.lit(2), "n": F.lit(3)})
    got = by_row(projections.near_vectors(df), "vec_id", "n_links", "component_id", "kept")
    linked = {1: (1, 1, True), 2: (1, 1, False), 12: (1, 12, True)}
    expected = [(None, 0, None, None)] + [(i, *linked.get(i, (0, i, True))) for i in [*range(1, 13), 12]]
    assert got == expected
    assert projections.near_vectors(df.filter("false")).count() == 0


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold among thousands of others: nine in ten at least are found, and no pair below it."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = rng.standard_normal((1500, 64))
    aside -= (aside * base).sum(1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = rng.uniform(0.92, 0.96, (1500, 1))
    near = cosine * base + np.sqrt(1 - cosine**2) * aside
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(np.concatenate([base, near]))], "vec_id long, embedding array<double>, label int")
    spec = projections.PassSpec(window=32)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in projections.near_vectors(df, spec).collect()}
    linked = {k for k in range(1500) if got[1500 + k][1] == k}
    above = {k for k in range(1500) if float(base[k] @ near[k]) >= 0.93}
    assert linked <= above and len(linked) >= 0.9 * len(above)
    assert all(got[k][0] == (k in linked) for k in range(1500))
