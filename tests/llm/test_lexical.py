"""Operator 12 against plain Python: terms, shared sums, ranks, edges."""

import math
import random
import re

import numpy as np
import pytest

from larder.llm import lexical
from larder.llm.tables import ready

from .conftest import EDGES, by_row

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, best=10):
    texts = [(i, plain_terms(t)) for i, t in docs]
    n_docs, n_words = sum(bool(t) for _, t in texts), sum(len(t) for _, t in texts)
    wanted = {}
    for i, text in dict.fromkeys(items):
        wanted.setdefault(i, []).extend(plain_terms(text))
    df = {t: sum(t in set(ts) for _, ts in texts) for t in {t for ts in wanted.values() for t in ts}}
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, ts in texts:
            m = 25 + 75 * len(ts) * n_docs // n_words if n_words else 0
            score = 0
            for t in terms:
                if tf := ts.count(t):
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:best])]
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


COLUMNS = ("item_id", "rank", "doc_id", "score")


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Ärger", "É", "x1"]
    docs = [(k, " ".join(rng.choices(vocabulary[: rng.randint(3, 63)], k=rng.randint(0, 40)))) for k in range(120)]
    docs += [(k, docs[3][1]) for k in (500, 501, None, None)] + [(None, ""), (7, None)]
    common = rng.sample(vocabulary, 12)
    items = [(k, " ".join(common[: rng.randint(1, 12)] + rng.choices(vocabulary, k=rng.randint(0, 8)))) for k in range(25)]
    return docs, [*items, items[0], (1, "w1 w1 w2"), (None, "w5"), (90, None), (91, "?!"), (92, "nirgends")]


@pytest.mark.parametrize("seed, block_terms", [(1, 1 << 18), (2, 40)])
def test_ranks_equal_brute_force(spark, monkeypatch, seed, block_terms):
    ready(spark)
    monkeypatch.setattr(lexical, "CELLS", 1 << 22 if seed == 1 else 500)
    docs, items = corpus(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert by_row(lexical.rank(d, i, block_terms=block_terms), *COLUMNS) == brute(docs, items)


def test_edges(spark, edges, nothing):
    items = [(0, "text one TWO y 漢字 é"), (1, "word x"), (2, "zeile ende A")]
    i = spark.createDataFrame(items, "item_id long, text string")
    assert by_row(lexical.rank(edges, i), *COLUMNS) == brute([r[:2] for r in EDGES], items)
    assert lexical.rank(nothing, i).collect() == [] and lexical.rank(edges, i.filter("false")).collect() == []
    assert [n for n, _ in lexical.rank(nothing, i).dtypes] == list(COLUMNS)


def test_terms_are_runs_of_letters_and_digits():
    for text in ["Ab9-c_d É漢ß\x00\x7fz", "", "a.b\U0001f600c Z", None]:
        assert lexical.terms_of(text) == plain_terms(text)


def test_shared_sums_are_made_once_and_add_up():
    rng = random.Random(4)
    common = rng.sample(range(200), 20)
    items = [dict.fromkeys([*common[: rng.randint(5, 20)], *rng.sample(range(200), 5)], 1) for _ in range(60)] + [{3: 2}, {3: 1, 5: 2}]
    program = lexical.sharing_program(items)
    values = np.array(rng.choices(range(1000), k=200 * 3)).reshape(200, 3)
    expected = [[sum(values[t, d] * n for t, n in item.items()) for d in range(3)] for item in items]
    assert program.scores(values).tolist() == expected
    assert program.additions < 0.6 * sum(len(item) - 1 for item in items)
    pairs = [(a, b) for left, right in program.levels for a, b in zip(left.tolist(), right.tolist())]
    assert len(pairs) == len(set(pairs))
    assert lexical.sharing_program([{1: 1}]).additions == 0
