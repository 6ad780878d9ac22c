"""The pipeline, stage by stage, against the operators' brute-force versions."""

import random

import numpy as np
import pytest

import corpus_pipeline
from larder.llm import ordinal, outliers
from larder.llm.tables import read, ready

from .conftest import EDGES, by_row
from .test_outliers import plain_counts
from .test_pairs import brute, plain_fingerprint
from .test_tokens import check_packing


@pytest.fixture(scope="module")
def stages(spark, small):
    docs = read(ready(spark), small, "documents")
    results = [docs]
    for name, function in corpus_pipeline.STAGES:
        results.append(corpus_pipeline.stage(function(spark, results[-1], small), name))
    return results


def test_stages_keep_the_columns_and_only_drop_rows(spark, small, stages):
    docs = stages[0]
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert after.dtypes == docs.dtypes
        assert after.exceptAll(before).count() == 0 and 0 < after.count() <= before.count()
    # Of these few documents the rules have left no poor one for the classifier: it shows on all of them.
    for number in (0, 1, 2):
        after = corpus_pipeline.STAGES[number][1](spark, docs, small)
        assert after.exceptAll(docs).count() == 0 and 0 < after.count() < docs.count()


def test_rules_drop_what_fails_them(stages):
    before, after = stages[:2]
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    judged = {r["doc_id"]: r for r in outliers.robust_outliers(before).collect()}
    for r in before.collect():
        failed = plain_counts(r["doc_id"], r["text"])[-1]
        distance = judged[r["doc_id"]]["distance"]
        assert (r["doc_id"] in kept) == (not failed and (distance is None or distance <= outliers.McdSpec().cutoff))


def test_classifier_keeps_good_documents(spark, small, stages):
    before, after = stages[1:3]
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    labels = {r["doc_id"]: r["label"] for r in ordinal.graded(read(spark, small, "labels")).collect()}
    rated = [r["doc_id"] for r in before.select("doc_id").collect() if r["doc_id"] in labels]
    assert all(i in kept for i in rated if labels[i] == 2)
    assert np.mean([i in kept for i in rated if labels[i] == 0] or [0]) < 1  # the rules have left few of them


def test_one_document_of_each_group_stays(stages):
    before, after = stages[2:4]
    found = brute([(r["doc_id"], plain_fingerprint(r["text"])) for r in before.collect()])
    assert {r["doc_id"] for r in after.collect()} == {i for i, _, least in found if i == least}


def test_what_stays_is_packed(spark, small, stages):
    texts = [(r["doc_id"], r["text"]) for r in stages[3].collect()]
    check_packing(stages[4].collect(), texts, 2048)
    assert by_row(corpus_pipeline.run(spark, small), "doc_id", "piece", "ids_crc32") == by_row(stages[4], "doc_id", "piece", "ids_crc32")


def test_edges_pass_through(spark, small, edges, nothing):
    for docs in (edges, nothing):
        for _, function in corpus_pipeline.STAGES:
            docs = function(spark, docs, small)
        assert docs.count() == 0  # no edge case has 20 words that are not repeats
    stages = dict(corpus_pipeline.STAGES)
    graded = stages["quality_classifier"](spark, edges, small)
    assert graded.columns == edges.columns and graded.exceptAll(edges).count() == 0
    kept = stages["near_duplicates"](spark, edges, small)
    assert kept.columns == edges.columns
    # Empty, null and blank texts are one group; of equal texts the one with the least id stays.
    assert by_row(kept, "doc_id", "text") == sorted(
        [(i, t) for i, t in dict.fromkeys(r[:2] for r in EDGES) if i is not None and (i, t) not in {(2, EDGES[0][1]), (4, None), (5, " \t\n ")}]
        + [(None, "A text without an id")],
        key=lambda r: [(x is not None, x) for x in r],
    )


def test_stages_decide_for_each_row(spark, small):
    stages, rng = dict(corpus_pipeline.STAGES), random.Random(6)
    good = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    schema = "doc_id long, text string, lang string, source string"
    rows = [(i, t, "en", "a") for t in good for i in (None, 7)] + [(i, "junk junk", "en", "a") for i in (None, 7)]
    kept = stages["quality_rules"](spark, spark.createDataFrame(rows, schema), small).collect()
    assert kept and not any(r["text"] == "junk junk" for r in kept)

    judged = {}
    for same in (False, True):
        rows = [(None if same else i, t, "en", "a") for i, t in enumerate(good)]
        judged[same] = by_row(stages["quality_classifier"](spark, spark.createDataFrame(rows, schema), small), "text")
    assert judged[True] == judged[False] and 0 < len(judged[True]) < len(good)

    texts = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=80)) for _ in range(4)]
    ids = {0: [3, 3, 2, None], 1: [5, 5], 2: [None, None], 3: [5]}
    rows = [(i, texts[t], "en", "a") for t, found in ids.items() for i in found]
    kept = stages["near_duplicates"](spark, spark.createDataFrame(rows, schema).repartition(2), small).collect()
    assert sorted((texts.index(r["text"]), r["doc_id"]) for r in kept if r["doc_id"]) == [(0, 2), (1, 5), (3, 5)]
    assert [texts.index(r["text"]) for r in kept if r["doc_id"] is None] == [2]


def test_rows_are_numbered_by_file_and_place(spark, small):
    docs = corpus_pipeline.stage(read(ready(spark), small, "documents").repartition(3), "three")
    rows, number = corpus_pipeline._numbered(docs)
    assert rows.columns == [*docs.columns, number] and rows.select(number).distinct().count() == docs.count()
    first, second = (dict((r["doc_id"], r[number]) for r in x.collect()) for x in (rows, rows.select(number, "doc_id")))
    assert first == second
    twice, number = corpus_pipeline._numbered(docs.union(docs))
    assert twice.select(number).distinct().count() == 2 * docs.count()
