"""Forecasts corrected by profiles of other weeks."""

import random

import pytest
from pyspark.sql import functions as F

from larder.operators.forecast import FORECAST, Forecaster
from larder.plans.adaptive import correct_batch, held_out_correction


class Flat(Forecaster):
    def fit(self, df, validation=None):
        return self

    def transform(self, df):
        return df.withColumn(FORECAST, F.lit(100.0))


def rows(seed=5, weeks=24):
    rng = random.Random(seed)
    pairs = [(1, 7, 40), (1, 8, 0), (2, 7, -30)]
    data = [(w * 10 + k, w, c, m, 100.0 + shift + rng.randrange(-20, 20)) for w in range(1, weeks + 1) for k, (c, m, shift) in enumerate(pairs)]
    return [*data, (900, 2, 3, 9, 150.0)]  # a pair of one week


SCHEMA = "id bigint, week int, center_id bigint, meal_id int, num_orders double"


def corrected(spark, data, **options):
    df = spark.createDataFrame(data, SCHEMA)
    return {r["id"]: r["adaptive_orders"] for r in held_out_correction(df, Flat(), **options).collect()}


@pytest.mark.parametrize("parts, part_weeks", [(2, 1), (3, 4), (4, 2)])
def test_equals_brute_force(spark, parts, part_weeks):
    data = rows()
    part = {w: (w - 1) // part_weeks % parts for _, w, *_ in data}
    want = {}
    for number, week, center, meal, _ in data:
        others = [(w, n, y - 100) for n, w, c, m, y in data if (c, m) == (center, meal) and part[w] != part[week]]
        last = [e for _, _, e in sorted(others, reverse=True)[:10]]
        bias = sum(last) / len(last) if len(others) >= 3 else 0.0
        want[number] = max(0.0, 100 + 0.65 * bias)
    got = corrected(spark, data, parts=parts, part_weeks=part_weeks)
    assert got.keys() == want.keys()
    assert all(got[n] == pytest.approx(want[n], abs=0.0051) for n in want)  # profiles have two digits


def test_a_week_does_not_see_itself(spark):
    """Other demand in the first part changes no correction there, and changes those of the rest."""
    data = rows()
    other = [(n, w, c, m, y + (500 if (w - 1) // 4 % 3 == 0 else 0)) for n, w, c, m, y in data]
    before, after = corrected(spark, data), corrected(spark, other)
    inside = {n for n, w, *_ in data if (w - 1) // 4 % 3 == 0}
    assert all(before[n] == after[n] for n in inside)
    assert any(before[n] != after[n] for n in before.keys() - inside)


def test_the_gain_out_of_sample_is_the_smaller_one(spark):
    """Pure noise cannot be corrected; in sample it seems to be."""
    rng = random.Random(1)
    data = [(w * 100 + c, w, c, 1, 100.0 + rng.choice([-60, 60])) for w in range(1, 9) for c in range(60)]
    df = spark.createDataFrame(data, SCHEMA)

    def error(frame):
        return frame.agg(F.sum(F.pow(F.col("num_orders") - F.col("adaptive_orders"), 2))).first()[0]

    inside, outside = error(correct_batch(df, Flat())[0]), error(held_out_correction(df, Flat(), parts=2))
    assert inside < 3600 * len(data) < outside


def test_edges(spark):
    assert corrected(spark, []) == {}
    assert corrected(spark, [(1, None, 1, 1, 50.0), (2, 1, None, 1, 50.0), (3, 1, 1, 1, None)]) == {1: 100.0, 2: 100.0, 3: 100.0}
    with pytest.raises(ValueError):
        corrected(spark, rows(), parts=1)
