"""Operator 4: its training sample under hot ids and dirty labels, and whole results against plain Python."""

import random

import numpy as np
from pyspark.sql import functions as F

from larder.llm import languages

SPEC = languages.ProfileSpec(size=128, most_rows=50)
SCHEMA = "doc_id long, text string, lang string"


def plain_vector(text, spec=SPEC):
    """Sum of the bound vectors of all n-grams of the lower-cased words, with one edge around each word."""
    letters = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    line = [0]
    for code in [*letters, 0]:
        if code or line[-1]:
            line.append(code)
    total = np.zeros(spec.size)
    for i in range(len(line) - spec.gram + 1):
        product = np.ones(spec.size)
        for place, code in enumerate(line[i : i + spec.gram]):
            product *= np.roll(languages.letter_vectors(np.array([code]), spec)[0], spec.gram - 1 - place)
        total += product
    return total


def unit(vector):
    length = np.linalg.norm(vector)
    return vector / length if length else vector


def made_up(rows=90):
    rng = random.Random(4)
    alphabets = {"aa": "abcdef", "bb": "defghi", "cc": "ghijéü"}
    for i in range(rows):
        lang = sorted(alphabets)[i % 3]
        words = ["".join(rng.choice(alphabets[lang]) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(0, 25))]
        yield i, "  ".join(words).upper() if i % 7 == 0 else ", ".join(words), lang if i % 10 else None


def test_profiles_and_predictions_equal_plain_python(spark):
    data = list(made_up())
    got = languages.identify(spark.createDataFrame(data, SCHEMA), F.col("doc_id") % 4 != 2, SPEC).collect()
    profiles = {}
    for i, text, lang in data:
        if i % 4 != 2 and lang:
            profiles[lang] = profiles.get(lang, 0) + unit(plain_vector(text))
    profiles = {lang: unit(vector) for lang, vector in profiles.items()}
    assert len(got) == len(data)
    for row in got:
        vector = unit(plain_vector(data[row["doc_id"]][1]))
        cosines = {lang: float(vector @ profile) for lang, profile in profiles.items()}
        if not vector.any():
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        best = max(cosines.values())
        assert abs(row["score"] - max(best, 0)) < 1e-4 and cosines[row["lang_pred"]] > best - 1e-4


def test_a_hot_row_counts_once(spark):
    rare = spark.range(40).selectExpr("id as doc_id", "concat('abc', id) as text", "'aa' as lang")
    hot = spark.range(30_000).selectExpr("7L as doc_id", "'xyz xyz' as text", "'aa' as lang")
    got = languages.training_texts(rare.unionByName(hot), SPEC)
    assert got.count() == 41 and got.filter("text = 'xyz xyz'").count() == 1


def test_one_id_with_many_texts_stays_within_the_bound(spark):
    hot = spark.range(30_000).selectExpr("7L as doc_id", "concat('t', id) as text", "'aa' as lang")
    other = spark.range(5_000).selectExpr("id + 100 as doc_id", "concat('u', id) as text", "'bb' as lang")
    sizes = languages.training_texts(hot.unionByName(other), languages.ProfileSpec(most_rows=2000)).groupBy("lang").count()
    sizes = {r["lang"]: r["count"] for r in sizes.collect()}
    assert set(sizes) == {"aa", "bb"} and all(1700 < n < 2300 for n in sizes.values())


def test_a_column_of_very_many_labels_is_bounded(spark):
    dirty = spark.range(3_000).selectExpr("id as doc_id", "'abc def' as text", "concat('l', id) as lang")
    clean = spark.range(3_000, 3_040).selectExpr("id as doc_id", "'xyz' as text", "if(id % 2 = 0, 'aa', 'bb') as lang")
    spec = languages.ProfileSpec(size=64, most_languages=4)
    found = languages.fit(dirty.unionByName(clean), spec)
    assert found.languages == ["aa", "bb", "l0", "l1"] and found.vectors.shape == (4, 64)


def test_equal_profiles_tie_to_the_first_language(spark):
    data = [(i, "abc abd", lang) for i, lang in enumerate(["zz", "mm", "aa", "mm"])] + [(9, "abc", None)]
    got = languages.identify(spark.createDataFrame(data, SCHEMA), F.lit(True), SPEC).collect()
    assert {r["lang_pred"] for r in got} == {"aa"}
