"""Operators 2, 4 and 7: held-out accuracy, and their parts against brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from larder.llm import languages, ordinal, toxicity
from larder.llm.blocks import text_blocks
from larder.llm.hashed import sampled
from larder.llm.tables import read, ready, remainder

from .conftest import EDGES, by_row

BAD = ["vile", "rotten", "idiot", "scum", "clown"]


def made_up(seed=1, rows=1500):
    """Texts with common and rare words; every fourth insults, every fifth is shouted."""
    rng = random.Random(seed)
    common = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(150)]
    for k in range(rows):
        words = [rng.choice(common) if rng.random() < 0.9 else f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 120))]
        toxic, poor = k % 4 == 0, k % 5 == 0
        for _ in range(1 + len(words) // 30 if toxic else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(BAD))
        if poor:
            words = [w.upper() + "!!" for w in words]
        yield k, " ".join(words), int(not poor), int(toxic)


def frames(spark):
    ready(spark)
    rows = list(made_up())
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], *r[2:]) for r in rows], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_fold_is_the_crc_of_the_decimal_id(spark):
    got = spark.createDataFrame([(7,), (123456,), (None,)], "doc_id long").select("doc_id", remainder("doc_id", 3).alias("m")).collect()
    assert [(r["doc_id"], r["m"]) for r in got] == [(7, zlib.crc32(b"7") % 3), (123456, zlib.crc32(b"123456") % 3), (None, None)]


def test_toxicity_on_held_out_texts(spark):
    rows, docs, labels = frames(spark)
    fold = remainder("doc_id", 3) != 1
    # Labels outside the fold say the opposite; they must not matter.
    twisted = labels.withColumn("toxic", F.when(fold, F.col("toxic")).otherwise(1 - F.col("toxic")))
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, twisted, fold).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    assert np.mean([got[r[0]]["predicted"] for r in held if r[3]]) >= 0.9
    assert np.mean([got[r[0]]["predicted"] for r in held if not r[3]]) <= 0.01


def test_toxicity_weights_are_sparse_and_score_as_stated(spark):
    rows, docs, labels = frames(spark)
    spec = toxicity.FtrlSpec(epochs=4)
    model = toxicity.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")), spec)
    assert 0 < len(model.features) < 0.2 * 1500 * 60 and (model.weights != 0).all() and (np.diff(model.features) > 0).all()
    from larder.llm import hashed

    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    weight = dict(zip(model.features.tolist(), model.weights))
    for _, block in text_blocks(pa.array([r[1] for r in rows[:50]])):
        found_rows, found = hashed.grams(block)
        for k in range(50):
            total = model.bias + sum(weight.get(f, 0) for f in set(found[found_rows == k].tolist()))
            assert abs(got[k] - 1 / (1 + np.exp(-total))) < 1e-9


def test_ftrl_step_by_hand():
    spec = toxicity.FtrlSpec(rate=0.5, smooth=1, l1=0.1, l2=0.0)
    z, n = toxicity.ftrl(spec)([np.zeros(3), np.zeros(3)], [np.array([0])], [np.array([1])], np.array([1]))
    assert np.allclose(z, [-0.5, 0, -0.5]) and np.allclose(n, [0.25, 0, 0.25])
    z2, n2 = toxicity.ftrl(spec)([z.copy(), n.copy()], [np.array([0, 1])], [np.array([1, 1])], np.array([0]))
    w = np.array([(0.5 - 0.1) / (1.5 / 0.5), 0, 0.5 / (1.5 / 0.5)])
    p = 1 / (1 + np.exp(-w.sum()))
    sigma = (np.sqrt(n + p * p) - np.sqrt(n)) / 0.5
    assert np.allclose(z2, z + p - sigma * w) and np.allclose(n2, n + p * p)


def test_sample_bound(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    found = {r["label"]: r["count"] for r in sampled(df, "label", 1000).groupBy("label").count().collect()}
    assert all(800 < n < 1200 for n in found.values())
    assert sampled(df, "label", 50_000).count() == 20_000


def test_scores_on_edges_and_without_labels(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (2, None, None), (None, 1, 1), (3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    everywhere = F.lit(True)
    for docs, known in ((edges, labels), (edges, labels.filter("false")), (nothing, labels)):
        number = docs.count()
        scored = toxicity.toxicity(docs, known, everywhere)
        assert scored.count() == number == scored.filter("score between 0 and 1").count()
        rated = ordinal.quality(docs, known)
        assert rated.count() == number == rated.filter("expected_grade between 0 and 2 and tails[0] >= tails[1]").count()
    empty = [r["score"] for r in toxicity.toxicity(edges, labels, everywhere).filter("doc_id in (3, 4, 5)").collect()]
    assert len(set(empty)) == 1


def test_grades(spark):
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 1), (3, 1, 0), (4, 1, None), (5, None, 1), (6, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    assert by_row(ordinal.graded(labels), "doc_id", "label") == [(1, 0), (2, 1), (3, 2), (4, 2), (6, 0)]


def test_link_gradient_is_the_derivative():
    cuts, small = np.array([-0.3, 0.8]), 1e-6

    def loss(s, cuts, grade):
        tail = np.concatenate([[1], 1 / (1 + np.exp(-(s - cuts))), [0]])
        return -np.log(tail[grade] - tail[grade + 1])

    for grade in range(3):
        by_score, by_cut = ordinal.link_gradient(0.4, cuts, grade)
        assert abs(by_score - (loss(0.4 + small, cuts, grade) - loss(0.4 - small, cuts, grade)) / (2 * small)) < 1e-6
        for k in range(2):
            step = np.eye(2)[k] * small
            assert abs(by_cut[k] - (loss(0.4, cuts + step, grade) - loss(0.4, cuts - step, grade)) / (2 * small)) < 1e-6


def test_quality_on_held_out_texts(spark):
    rows, docs, labels = frames(spark)
    got = {r["doc_id"]: r for r in ordinal.quality(docs, labels, remainder("doc_id", 3) != 1).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    good, poor = [r for r in held if r[2]], [r for r in held if not r[2]]
    assert np.mean([got[r[0]]["kept"] for r in good]) >= 0.99 and np.mean([got[r[0]]["kept"] for r in poor]) <= 0.05
    grades = [np.mean([got[r[0]]["expected_grade"] for r in rows if g(r)]) for g in (lambda r: not r[2], lambda r: r[2] and r[3], lambda r: r[2] and not r[3])]
    assert grades[0] < grades[1] < grades[2]


def test_gram_vectors_are_bound_letters():
    spec = languages.ProfileSpec(size=256)
    table = {c: languages.letter_vectors(np.array([ord(c)]), spec)[0].astype(int) for c in "abc"}
    (vector,) = languages.gram_vectors(np.array([[ord(c) for c in "abc"]]), spec).astype(int)
    assert (vector == np.roll(table["a"], 2) * np.roll(table["b"], 1) * table["c"]).all()
    assert set(np.unique(vector)) == {-1, 1} and abs(table["a"] @ table["b"]) < 80


def test_text_vectors_are_sums_of_gram_vectors():
    spec = languages.ProfileSpec(size=128)
    texts = ["Ab, c!", "", "  ", "é" * 300 + " xyz", "12", "c"]
    for _, block in text_blocks(pa.array(texts)):
        ((first, got),) = languages.text_vectors(block, spec)
    assert first == 0
    for text, vector in zip(texts, got):
        letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        line = "\0" + "\0".join(letters) + "\0" if letters else ""
        grams = np.array([[ord(c) for c in line[k : k + 3]] for k in range(len(line) - 2)]).reshape(-1, 3)
        assert np.allclose(vector, languages.gram_vectors(grams, spec).sum(0) if len(grams) else 0)


def test_languages_on_held_out_documents(spark, small):
    docs = read(ready(spark), small, "documents")
    got = languages.identify(docs, remainder("doc_id", 4) != 2).join(docs.select("doc_id", "lang"), "doc_id").filter(remainder("doc_id", 4) == 2)
    rows = got.collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.97 and all(0 <= r["score"] <= 1 for r in rows)


def test_languages_on_edges(edges, nothing):
    rows = by_row(languages.identify(edges, F.lit(True)), "doc_id", "lang_pred", "score")
    assert len(rows) == len(EDGES) and languages.identify(nothing, F.lit(True)).count() == 0
    assert all((r[1], r[2]) == ("und", 0) for r in rows if r[0] in (3, 4, 5))
    assert all(r[1] in ("en", "fr", "de") and r[2] > 0 for r in rows if r[0] in (1, 6, 8))
    learned_nothing = languages.identify(edges, F.lit(False)).select("lang_pred").distinct().collect()
    assert [r[0] for r in learned_nothing] == ["und"]
