"""Trees grown from histograms of binned rows: MLlib's trees without its tables of vectors."""

import os

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from test_models_and_loop import TINY
from test_patience import forecasts, frame, spec

from larder.operators import boosted, histograms
from larder.operators.boosted import BoostedForecaster
from larder.session import SHUFFLE_CLEANUP, scratch


def both(monkeypatch, model, train, held):
    """The model fitted by MLlib's trees and from histograms."""
    out = []
    for rows in (10**9, 0):
        monkeypatch.setattr(boosted, "VECTOR_ROWS", rows)
        out.append(model().fit(train, held))
    return out


@pytest.mark.parametrize("changes", [{}, {"trees": 9, "depth": 5, "rate": 0.6, "patience": 2, "min_rows": 9}, {"depth": 0, "trees": 1}])
def test_they_are_the_trees_of_mllib(spark, monkeypatch, changes):
    monkeypatch.setattr(boosted, "BLOCK", 4)
    train, held = (frame(spark, *x).withColumn("c", F.col("id") % 7) for x in ((1, 600), (2, 300)))
    whole, ours = both(monkeypatch, lambda: BoostedForecaster(["a", "c", "b"], spec(**changes)), train, held)
    assert ours.model.getNumTrees == whole.model.getNumTrees
    assert list(ours.model.treeWeights) == list(whole.model.treeWeights)
    want, got = forecasts(whole, held), forecasts(ours, held)
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    assert ours.model.featureImportances.toArray() == pytest.approx(whole.model.featureImportances.toArray())
    for a, b in zip(whole.model.trees, ours.model.trees, strict=True):
        assert (a.numNodes, a.depth) == (b.numNodes, b.depth)


def test_no_table_of_vectors_and_none_is_left(spark, monkeypatch):
    """Five blocks: each replaces the one before. A row takes a byte for each feature, not eight."""
    monkeypatch.setattr(boosted, "BLOCK", 2)
    monkeypatch.setattr(boosted, "VECTOR_ROWS", 0)
    monkeypatch.setattr(BoostedForecaster, "_prepare", lambda *_: pytest.fail("rows were made vectors"))
    seen, whole = [], histograms.errors

    def errors(*arguments):
        (inner,) = os.listdir(folder.removeprefix("file:"))
        seen.append(sorted(n.split("-")[0] for n in os.listdir(f"{folder.removeprefix('file:')}/{inner}")))
        return whole(*arguments)

    monkeypatch.setattr(histograms, "errors", errors)
    with scratch(spark) as folder:
        BoostedForecaster(["a", "b"], spec(trees=10, depth=2)).fit(frame(spark, 1), frame(spark, 2))
        assert seen == [["train", "validation"], *[["boosting", "boosting"]] * 4]
        assert not os.listdir(folder.removeprefix("file:"))
        label = F.log1p("num_orders")
        rows = histograms.binned(frame(spark, 1), ["a", "b"], label, [np.array([0.5])] * 2, 64, True).agg(F.sum(F.length("points")))
        assert rows.first()[0] == 600 * 2


def test_shares_of_rows_and_columns(spark, monkeypatch):
    monkeypatch.setattr(boosted, "VECTOR_ROWS", 0)
    df = frame(spark, 3)
    half = BoostedForecaster(["a", "b"], spec(row_share=0.5, column_share=0.5, trees=5, depth=2, rate=0.5)).fit(df, df)
    counts = [t._call_java("rootNode").impurityStats().rawCount() for t in half.model.trees]
    assert all(200 < n < 400 for n in counts) and len(set(counts)) > 1
    assert {r["feature"] for r in half.importances().collect()} == {"a", "b"}
    flat = BoostedForecaster(["b"], spec(trees=1, depth=0)).fit(df, df)
    assert half.evaluate(df).first().rmse < 0.8 * flat.evaluate(df).first().rmse


@pytest.mark.parametrize("value", [None, float("nan"), float("inf")])
def test_training_rows_must_be_whole_and_others_need_not(spark, monkeypatch, value):
    monkeypatch.setattr(boosted, "VECTOR_ROWS", 0)
    df = frame(spark, 4, 100)
    broken = df.withColumn("a", F.when(F.col("id") == 3, F.lit(value).cast("double")).otherwise(F.col("a")))
    with pytest.raises(PythonException, match="must not be missing or infinite"):
        BoostedForecaster(["a", "b"], spec()).fit(broken, df)
    whole, ours = both(monkeypatch, lambda: BoostedForecaster(["a", "b"], spec(trees=4, depth=2)), df, broken)
    assert ours.model.getNumTrees == whole.model.getNumTrees


def test_cuts_of_many_values_follow_their_number():
    values = np.concatenate([np.zeros(500), np.arange(1, 501)])
    cuts = histograms.cut_points(values, 10)
    assert len(cuts) <= 9 and cuts[0] == 0.5
    assert np.diff(np.searchsorted(values[500:], cuts)).max() <= 101
    assert list(histograms.cut_points(np.array([3.0, 1.0, 1.0]), 10)) == [2.0] and not len(histograms.cut_points(np.ones(4), 10))


def test_training_keeps_neither_the_panel_nor_its_shuffles(spark, monkeypatch, tmp_path):
    from panels import store_panel

    from larder.config import Settings, WeekSplit
    from larder.plans import training

    seen = []

    class Looked(BoostedForecaster):
        def fit(self, df, validation=None):
            seen.extend(n.split("-")[0] for n in os.listdir(folder.removeprefix("file:")))
            seen.append(spark.conf.get(SHUFFLE_CLEANUP))
            return super().fit(df, validation)

    df = store_panel(spark)
    raw = ["id", "week", "center_id", "meal_id", "checkout_price", "base_price", "emailer_for_promotion", "homepage_featured", "num_orders"]
    tables = {"train": df.select(*raw), "centers": df.select("center_id", "center_type").distinct(), "meals": df.select("meal_id", "cuisine").distinct()}
    with scratch(spark) as folder:
        made = training.train(tables, Settings(split=WeekSplit(20, 24, 31), boost=TINY), Looked(["checkout_price", "week"], TINY), str(tmp_path / "out"))
        assert made.train_rows and made.test_rows and made.totals.first().total_forecasted_units > 0
    assert "train" not in seen and seen[-1] == "true" and spark.conf.get(SHUFFLE_CLEANUP, "false") == "false"
