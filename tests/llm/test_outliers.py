"""Operator 6 against brute force: the base counts, and the estimates by numpy."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import outliers
from larder.llm.tables import read, ready

from .conftest import EDGES, by_row

COUNTS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def plain_counts(doc_id, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often, covered = collections.Counter(windows), set()
    for k, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(k, k + 8))
    n, repeats = len(words), len(covered)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return doc_id, n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeats, n < 20 or 100 * repeats > 30 * n


def nulls_first(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


def test_base_counts(spark, edges, nothing):
    rng = random.Random(4)
    texts = [(r[0], r[1]) for r in EDGES]
    texts += [(100 + k, " ".join(rng.choice("ab") for _ in range(rng.randrange(40))) + rng.choice(["", "\n", " \x0b\x0c"])) for k in range(60)]
    texts += [(200 + k, "\n".join(rng.choice(["x y", "", " ", "z", "\t"]) for _ in range(12))) for k in range(20)]
    texts += [(300, "a\x85b c  d \x1c"), (301, "1 2 3 4 5 6 7 8 " * 2), (302, "1 2 3 4 5 6 7 8 9 " * 3 + "x")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert by_row(outliers.base_counts(df), *COUNTS) == nulls_first([plain_counts(*t) for t in texts])
    assert outliers.robust_outliers(nothing).count() == 0


def test_edges_are_judged_by_the_base_rules_without_an_estimate(edges):
    got = outliers.robust_outliers(edges)
    expected = [(*plain_counts(r[0], r[1]), None, not plain_counts(r[0], r[1])[-1]) for r in EDGES]
    assert by_row(got, *COUNTS, "distance", "kept") == nulls_first(expected)


def distances(z, centre, scatter):
    return np.einsum("ij,jk,ik->i", z - centre, np.linalg.inv(scatter), z - centre)


def plain_mcd(groups, spec):
    """Centre and scatter of each group of vectors, by the same steps with numpy; all groups step together."""
    floors, states = np.diag(np.square(spec.floors)), {}
    for name, z in groups.items():
        middle = np.quantile(z, 0.5, axis=0, method="inverted_cdf")
        spread = 1.4826 * np.quantile(abs(z - middle), 0.5, axis=0, method="inverted_cdf")
        states[name, 0] = middle, np.diag(spread**2)
        states[name, 1] = z.mean(0), np.cov(z.T, bias=True)

    def det(scatter):
        return np.linalg.slogdet(scatter + floors)[1]

    for step in range(spec.steps):
        falls = []
        for (name, start), (centre, scatter) in states.items():
            d = distances(groups[name], centre, scatter + floors)
            near = groups[name][d <= np.quantile(d, spec.share, method="inverted_cdf")]
            states[name, start] = near.mean(0), np.cov(near.T, bias=True)
            falls.append(det(scatter) - det(states[name, start][1]))
        if step and max(falls) <= spec.settled:
            break
    best = {name: min((states[name, k] for k in range(2)), key=lambda s: det(s[1])) for name in groups}
    return {name: (centre, spec.consistency * scatter + floors) for name, (centre, scatter) in best.items()}


def test_estimates_equal_numpy(spark, small):
    """Groups of their own, pooled small groups, null languages and sources, and planted outliers."""
    ready(spark)
    rng = random.Random(6)

    def words(n, long):
        return " ".join("w" * rng.choice(long) + str(rng.randrange(1000)) for _ in range(n))

    rows = []
    for k in range(300):
        lang, source = [("en", "a"), ("en", "b"), (None, "a")][k % 3]
        text = words(rng.randrange(30, 400), (3, 4, 5)) if lang else words(rng.randrange(30, 90), (9, 10))
        rows.append((k, text, lang, source))
    rows += [(1000 + k, words(60, (4,)) , "en", f"small{k % 20}") for k in range(80)]
    rows += [(2000 + k, words(80, (4,)) + " %%% ### $$$" * 60, "en", "a") for k in range(5)]
    rows += [(3000 + k, words(80, (40,)), "en", "b") for k in range(5)]
    rows += [(4000 + k, words(80, (4,)), "fr", "rare") for k in range(5)]
    rows += [(5000, words(80, (60,)) + " %%% ###" * 90, "it", None)]  # an outlier of a rare language
    spec = outliers.McdSpec(least_rows=60, accuracy=100_000)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in outliers.robust_outliers(df, spec).collect()}
    groups = collections.defaultdict(list)
    sizes = collections.Counter((r[2], r[3]) for r in rows)
    for r in rows:
        groups[(r[2], r[3]) if sizes[r[2], r[3]] >= 60 else (r[2], "pooled")].append(r)
    vectors, usable = {}, {}
    for name, members in groups.items():
        base = [plain_counts(r[0], r[1]) for r in members]
        n = np.array([max(b[1], 1) for b in base], float)
        b = np.array([b[1:6] for b in base], float)
        vectors[name] = np.stack([np.log((b[:, 1] + 5) / (n + 1)), *(np.sqrt(b[:, k] / n) for k in (2, 3, 4)), np.log1p(n)], 1)
        usable[name] = ~np.array([c[6] for c in base])
    everything = np.concatenate([vectors[name][usable[name]] for name in groups])
    own = {name: vectors[name][usable[name]] for name in groups if usable[name].sum() >= 60}
    assert ("fr", "pooled") not in own
    estimates = plain_mcd({**own, "all": everything}, spec)
    for name, members in groups.items():
        expected = distances(vectors[name], *estimates[name if name in own else "all"])
        found = np.array([got[r[0]]["distance"] for r in members])
        assert np.allclose(found, expected, rtol=1e-6, atol=1e-6)
        assert [got[r[0]]["kept"] for r in members] == [bool(u and d <= spec.cutoff) for u, d in zip(usable[name], expected)]
    assert not any(got[k]["kept"] for k in [*range(2000, 2005), *range(3000, 3005), 5000])
    assert sum(got[k]["kept"] for k in range(300)) == 300


def test_kept_rows_are_those_that_the_verdict_keeps(spark, small, edges):
    docs = read(ready(spark), small, "documents").withColumn("kept", F.lit("a column of theirs"))
    spec = outliers.McdSpec(least_rows=40)
    verdict = {r["doc_id"]: r["kept"] for r in outliers.robust_outliers(docs, spec).collect()}
    kept = outliers.kept_rows(docs, spec)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    assert by_row(kept, "doc_id") == sorted((i,) for i, k in verdict.items() if k)
    assert outliers.kept_rows(edges).count() == 0


def test_consistency_belongs_to_the_share():
    z = np.random.default_rng(1).standard_normal((400_000, 5))
    d = (z**2).sum(1)
    inside = z[d <= np.quantile(d, outliers.McdSpec().share)]
    assert abs(inside.var() * outliers.McdSpec().consistency - 1) < 0.01


def test_good_documents_stay(spark, small):
    docs, labels = (read(ready(spark), small, t) for t in ("documents", "labels"))
    got = outliers.robust_outliers(docs, outliers.McdSpec(least_rows=40)).join(labels, "doc_id").filter("quality = 1 and not base_failed")
    assert got.count() == got.filter("kept").count()


def test_no_python_in_the_plan(spark, edges):
    text = outliers.robust_outliers(edges)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
    with pytest.raises(Exception):
        outliers.robust_outliers(edges.drop("lang"))
