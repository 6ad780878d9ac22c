import random

import numpy as np
import pytest
from conftest import rows

from larder.operators.heavy import cumulate, cut_series, exact_quantiles, group_median, group_quantiles, heavy_groups, value_counts

PROBS = [0.0, 0.1, 0.37, 0.5, 0.9, 1.0]


def data(seed):
    rng = random.Random(seed)
    hot = [("hot", rng.choice([rng.gauss(0, 100), float(rng.randint(0, 3))])) for _ in range(700)]
    return hot + [(f"k{rng.randint(0, 9)}", rng.gauss(10, 3)) for _ in range(600)] + [("one", 4.0)]


@pytest.mark.parametrize("light_rows", [10**6, 50, 0])
def test_quantiles_equal_numpy(spark, light_rows):
    points = data(light_rows)
    df = spark.createDataFrame(points, "k string, v double").repartition(4)
    got = group_quantiles(df, ["k"], "v", PROBS, light_rows=light_rows, pieces=8)
    groups = {k: [v for key, v in points if key == k] for k in {k for k, _ in points}}
    found = {r.k: r.quantiles for r in got.collect()}
    assert found.keys() == groups.keys()
    for k, values in groups.items():
        assert found[k] == [float(x) for x in np.quantile(values, PROBS)]


@pytest.mark.parametrize("light_rows", [10**6, 1])
def test_median_without_keys_and_with_missing_values(spark, light_rows):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (4.0,), (2.0,), (9.0,)], "v double")
    assert rows(group_median(df, [], "v", "m", light_rows=light_rows)) == [(3.0,)]
    assert rows(group_median(df.filter("v > 100 AND NOT isnan(v)"), [], "v", "m", light_rows=light_rows)) == []


def test_null_keys_are_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 5.0)], "k string, v double")
    assert rows(group_median(df, ["k"], "v", "m")) == [("a", 1.0)]


def test_heavy_groups_are_those_beyond_the_limit(spark):
    df = spark.range(10_000).selectExpr("case when id % 3 = 0 then 0 when id < 100 then 1 else id end as k")
    assert rows(heavy_groups(df, ["k"], light_rows=66).select("k", "group_rows")) == [(0, 3334)]
    assert heavy_groups(df, ["k"], light_rows=3334).count() == 0


def test_a_hot_group_is_cut_into_pieces_of_the_allowed_size(spark):
    """A third of the rows in one series: no task orders more than the limit of them."""
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id % 500) as k", "id as week", "cast(id as double) as y")
    cut = cut_series(df, ["k"], ["week"], 2, ["y"], light_rows=1000)
    sizes = cut.groupBy("k", "piece").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 1000 and sizes.filter("k = -1").count() >= 10
    assert cut.filter("NOT halo").count() == 30_000


def test_cumulate_equals_brute_force(spark):
    rng = random.Random(5)
    points = [(rng.choice("ab"), float(rng.randint(0, 400))) for _ in range(1500)]
    counts = value_counts(spark.createDataFrame(points, "k string, v double"), ["k"], "v")
    for k, value, _, upto in rows(cumulate(counts, "k", ["weight"], pieces=32)):
        assert upto == sum(1 for key, v in points if key == k and v <= value)


def test_weights(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 5.0, 1), ("a", 9.0, 0)], "k string, value double, w int")
    assert rows(exact_quantiles(df, ["k"], [0.5, 1.0], "w"))[0] == ("a", [1.0, 5.0])


def sketches(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("percentile_approx")


def test_split_points_are_worked_out_once(spark):
    """A sketch may come out differently the second time, so that a wanted piece would be looked for between other bounds."""
    df = spark.createDataFrame(data(1), "k string, v double")
    counts = value_counts(df, ["k"], "v")
    assert sketches(exact_quantiles(counts, ["k"], PROBS, light_rows=50, pieces=8)) == 1
    assert sketches(cumulate(counts, "k", ["weight"], pieces=8)) == 0  # written
    assert sketches(cut_series(df, ["k"], ["v"], 2, [], light_rows=50)) == 0
