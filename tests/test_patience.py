"""Boosting that stops while it trains."""

import random

import pytest
from pyspark.sql import functions as F

from larder.config import BoostSpec
from larder.operators import boosted
from larder.operators.boosted import BoostedForecaster, TreeAttribution
from larder.operators.forecast import FORECAST

SCHEMA = "id bigint, a double, b double, num_orders double"


def frame(spark, seed, n=600, noise=30):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        a, b = rng.random(), rng.random()
        rows.append((k, a, b, max(0.0, 100 + 80 * a - 50 * (b > 0.5) + rng.uniform(-noise, noise))))
    return spark.createDataFrame(rows, SCHEMA)


def forecasts(model, df):
    return {r["id"]: r[FORECAST] for r in model.transform(df).collect()}


def spec(**changes):
    return BoostSpec(**{"trees": 6, "depth": 3, "rate": 0.1, "row_share": 1.0, "column_share": 1.0, "min_rows": 2, **changes})


def test_trees_fitted_one_by_one_are_those_of_mllib(spark, monkeypatch):
    """The training rows as validation never stop it; blocks of four trees."""
    monkeypatch.setattr(boosted, "BLOCK", 4)
    df = frame(spark, 1)
    whole = BoostedForecaster(["a", "b"], spec()).fit(df)
    steps = BoostedForecaster(["a", "b"], spec()).fit(df, df)
    assert steps.model.getNumTrees == whole.model.getNumTrees == 6
    assert list(steps.model.treeWeights) == list(whole.model.treeWeights)
    want, got = forecasts(whole, df), forecasts(steps, df)
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    shown = {r["feature"]: r["importance"] for r in steps.importances().collect()}
    assert shown.keys() == {"a", "b"} and sum(shown.values()) == pytest.approx(1)


def test_patience_ends_the_fit(spark, monkeypatch):
    """Deep trees at full rate overfit at once: few of the 60 trees are fitted, each once, and the best are kept."""
    monkeypatch.setattr(boosted, "BLOCK", 4)
    fitted, seen = [], []
    one, errors = BoostedForecaster._tree, BoostedForecaster._errors

    def tree(self, rows, number):
        fitted.append(number)
        return one(self, rows, number)

    def measured(*arguments):
        seen.extend(errors(*arguments))
        return seen[-len(arguments[1]) :]

    monkeypatch.setattr(BoostedForecaster, "_tree", tree)
    monkeypatch.setattr(BoostedForecaster, "_errors", staticmethod(measured))
    monkeypatch.setattr(BoostedForecaster, "_regressor", lambda *_: pytest.fail("fitted as a whole"))
    model = BoostedForecaster(["a", "b"], spec(trees=60, depth=6, rate=0.9, patience=3))
    model.fit(frame(spark, 1, 300), frame(spark, 2, 300))
    assert fitted == list(range(len(fitted))) and len(fitted) < 20 and len(fitted) == len(seen)
    best = min(range(len(seen)), key=seen.__getitem__) + 1
    assert model.model.getNumTrees == model.best_length(seen) <= best
    assert len(fitted) - model.best_length(seen) >= 3
    assert model.model.evaluateEachIteration(model._prepare(frame(spark, 2, 300)), "squared") == pytest.approx(seen[: model.model.getNumTrees])


def test_the_stopped_model_is_saved_and_explained(spark, tmp_path):
    df = frame(spark, 3)
    model = BoostedForecaster(["a", "b"], spec()).fit(df, frame(spark, 4))
    model.save(str(tmp_path / "m"))
    back = BoostedForecaster.load(spark, str(tmp_path / "m"))
    want, got = forecasts(model, df), forecasts(back, df)
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    paths = TreeAttribution(model)
    parts = model.transform(df).withColumn("total", F.aggregate(paths.parts(), F.lit(paths.base), lambda x, y: x + y))
    assert all(r[FORECAST] == pytest.approx(max(0.0, 2.718281828459045 ** r["total"] - 1), rel=1e-6) for r in parts.collect())


def test_no_validation_rows(spark):
    df = frame(spark, 5, 100)
    assert BoostedForecaster(["a", "b"], spec(patience=1)).fit(df, df.filter("false")).model.getNumTrees == 6
