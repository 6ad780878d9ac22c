import itertools
import math
import random

import numpy as np
import pytest
from conftest import rows

from larder.operators import drift, profiles, split
from larder.operators.drift import feature_drift, psi, side_counts, two_sides

PROFILE = (
    "id bigint, week int, center_id bigint, meal_id int, checkout_price double, any_promo int, "
    "forecast_orders double, num_orders double"
)


def batch(spark, n=14, price=lambda w: 100.0, actual=lambda w: 90.0, forecast=80.0, promo=lambda w: int(w % 3 == 0), center=1):
    data = [(w, w, center, 7, price(w), promo(w), forecast, float(actual(w))) for w in range(1, n + 1)]
    return spark.createDataFrame(data, PROFILE)


def one(df):
    return profiles.sku_profiles(df).first()


def test_plain_profile(spark):
    p = one(batch(spark))
    assert (p.average_weekly_demand, p.recent_residual_bias, p.residual_std) == (90.0, 10.0, 3.0)
    assert (p.promo_uplift_ratio, p.price_elasticity_estimate) == (1.0, -1.2)
    assert (p.recommended_safety_stock, p.volatility_tier, p.volume_tier) == (5.0, "LOW", "MEDIUM")


def test_bias_is_over_the_last_ten_weeks(spark):
    p = one(batch(spark, actual=lambda w: 500.0 if w <= 4 else 70.0 + w, forecast=70.0))
    assert p.recent_residual_bias == 9.5


def test_short_history_keeps_defaults(spark):
    p = one(batch(spark, n=2))
    assert (p.recent_residual_bias, p.residual_std, p.price_elasticity_estimate, p.promo_uplift_ratio) == (0.0, 20.0, -1.2, 1.25)


def test_elasticity_and_uplift_are_clipped(spark):
    steep = one(batch(spark, price=lambda w: 10.0 + w, actual=lambda w: 1000.0 / (10 + w) ** 6 * 1e6))
    assert steep.price_elasticity_estimate == -4.0
    strong = one(batch(spark, actual=lambda w: 900.0 if w % 3 == 0 else 10.0))
    assert strong.promo_uplift_ratio == 3.5


def test_elasticity_is_the_least_squares_slope(spark):
    rng = random.Random(1)
    noise = [rng.uniform(0.9, 1.1) for _ in range(20)]
    price, demand = (lambda w: 50.0 + 5 * w), (lambda w: round(1e4 / (50 + 5 * w) * noise[w - 1], 2))
    p = one(batch(spark, n=20, price=price, actual=demand))
    x, y = np.log([price(w) for w in range(1, 21)]), np.log1p([demand(w) for w in range(1, 21)])
    assert p.price_elasticity_estimate == pytest.approx(np.polyfit(x, y, 1)[0], abs=0.006)


@pytest.mark.parametrize("std, tier", [(15.0, "LOW"), (15.1, "MEDIUM"), (35.0, "MEDIUM"), (35.1, "HIGH")])
def test_volatility_bounds(spark, std, tier):
    p = one(batch(spark, actual=lambda w: 80.0 + (std if w % 2 else -std)))
    assert (p.residual_std, p.volatility_tier) == (std, tier)


def test_a_deviation_on_the_bound_does_not_depend_on_the_order(spark):
    """Deviation exactly 15 in any order of the rows: not above the bound."""
    orders = set(itertools.permutations([19.0, 9.0, 9.0, -21.0])) | set(itertools.permutations([-4.0, 20.0, 14.0, -18.0]))
    data = [
        (10 * i + w, w, i, 7, 100.0, 0, 80.0, 80.0 + r) for i, residuals in enumerate(orders) for w, r in enumerate(residuals)
    ]
    found = profiles.sku_profiles(spark.createDataFrame(data, PROFILE).coalesce(1))
    assert rows(found.select("residual_std", "volatility_tier").distinct()) == [(15.0, "LOW")]


def test_a_small_deviation_beside_a_large_mean(spark):
    """The plain sums lose all digits there; the moments do not."""
    p = one(batch(spark, n=14, actual=lambda w: 1e9 + (40.0 if w % 2 else -40.0) + 0.1))
    assert p.residual_std == pytest.approx(40.0, abs=0.01)


@pytest.mark.parametrize("demand, tier", [(75.0, "LOW"), (75.5, "MEDIUM"), (250.0, "MEDIUM"), (250.5, "HIGH")])
def test_volume_bounds(spark, demand, tier):
    assert one(batch(spark, actual=lambda w: demand)).volume_tier == tier


def test_actual_orders_wins_and_missing_columns_give_defaults(spark):
    df = batch(spark).selectExpr("*", "120.0D AS actual_orders")
    assert one(df).average_weekly_demand == 120.0
    bare = profiles.sku_profiles(batch(spark).select("id", "week", "center_id", "meal_id")).first()
    assert (bare.average_weekly_demand, bare.residual_std, bare.recommended_safety_stock) == (50.0, 20.0, 33.0)


def test_pairs_with_null_keys_have_no_profile(spark):
    df = batch(spark).union(batch(spark).selectExpr("id", "week", "cast(null as bigint)", "meal_id", *batch(spark).columns[4:]))
    assert profiles.sku_profiles(df).count() == 1


def test_adaptive_forecast(spark):
    found = profiles.sku_profiles(batch(spark))
    df = batch(spark, n=1).union(batch(spark, n=1, center=2))
    got = rows(profiles.adaptive_forecast(df, found).select("center_id", "adaptive_orders", "adaptive_stock"), "center_id")
    assert got == [(1, 86.5, 5.0), (2, 80.0, 15.0)]


# --- drift -----------------------------------------------------------------------------------------


def plain_psi(expected, actual, bins=10):
    edges = np.unique(np.percentile(expected, np.linspace(0, 100, bins + 1)))
    if len(edges) < 2:
        return 0.0
    edges[0], edges[-1] = -np.inf, np.inf
    e = np.maximum(np.histogram(expected, edges)[0] / len(expected), 1e-4)
    a = np.maximum(np.histogram(actual, edges)[0] / len(actual), 1e-4)
    return float(np.clip(np.sum((a - e) * np.log(a / e)), 0, 10))


def plain_ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


def sides(spark, base, cur, name="f"):
    return two_sides(
        spark.createDataFrame([(v,) for v in base], f"{name} double"),
        spark.createDataFrame([(v,) for v in cur], f"{name} double"),
        [name],
    )


def samples(seed):
    rng = random.Random(seed)
    return {
        "shifted": ([rng.gauss(50, 10) for _ in range(300)], [rng.gauss(60, 10) for _ in range(200)]),
        "similar": ([rng.gauss(50, 10) for _ in range(300)], [rng.gauss(50, 10) for _ in range(300)]),
        "ties": ([float(rng.randint(0, 4)) for _ in range(200)], [float(rng.randint(1, 5)) for _ in range(100)]),
        "flag": ([float(i % 2) for i in range(100)], [0.0] * 60),
        "apart": ([1.0 + i for i in range(50)], [1000.0 + i for i in range(50)]),
    }


@pytest.mark.parametrize("name", ["shifted", "similar", "ties", "flag", "apart"])
def test_psi_and_ks_equal_brute_force(spark, name):
    base, cur = samples(3)[name]
    counts = side_counts(sides(spark, base, cur), ["f"])
    for light_rows in (10**6, 0):
        assert psi(counts, light_rows=light_rows, pieces=8).first().psi == pytest.approx(plain_psi(base, cur), abs=1e-9)
    got = drift.ks_test(counts, pieces=8).first()
    assert got.ks_statistic == pytest.approx(plain_ks(base, cur), abs=1e-12)


def test_known_drift_sizes(spark):
    base, cur = samples(4)["similar"]
    assert psi(side_counts(sides(spark, base, cur), ["f"])).first().psi < 0.15
    base, cur = samples(4)["shifted"]
    assert psi(side_counts(sides(spark, base, cur), ["f"])).first().psi > 0.2


def test_constants_missing_values_and_empty_sides(spark):
    def verdict(base, cur):
        r = feature_drift(sides(spark, base, cur), ["f"]).first()
        return r and (r.psi, r.ks_statistic, r.ks_p_value, r.is_drifted, r.severity)

    assert verdict([5.0] * 20, [5.0] * 20) == (0.0, 0.0, 1.0, False, "NONE")
    assert verdict([5.0] * 20, [6.0] * 20) == (0.0, 1.0, 0.0, True, "LOW")
    nan = float("nan")
    assert verdict([5.0, nan, float("inf")] * 10, [5.0, None, nan] * 10) == (0.0, 0.0, 1.0, False, "NONE")
    assert verdict([1.0, 2.0, 3.0], [9.0] * 3)[1:3] == (0.0, 1.0)
    assert verdict([1.0, 2.0], []) == (0.0, 0.0, 1.0, False, "NONE")


def test_p_value_known_points(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0.0, 100, 100), (0.1, 1000, 1000), (1.0, 50, 50), (1.36 / math.sqrt(5000), 10000, 10000)], "d double, n int, m int")
    p = [r[0] for r in rows(df.select(drift.ks_p_value(F.col("d"), F.col("n"), F.col("m"))))]
    assert p[0] == 1.0 and p[1] < 1e-3 and p[2] < 1e-10 and p[3] == pytest.approx(0.0494, abs=1e-3)


def test_status(spark):
    def status(drifted, features, p=None, ratio=None):
        df = spark.createDataFrame([(f"f{i}", i < drifted) for i in range(features)], "feature string, is_drifted boolean")
        one_row = lambda v, n: spark.createDataFrame([(v,)], f"{n} double")
        return drift.drift_status(df, one_row(p, "target_p_value"), one_row(ratio, "r")).first().status

    assert status(0, 20) == "HEALTHY" and status(3, 20) == "HEALTHY" and status(4, 20) == "MODERATE_DRIFT"
    assert status(7, 20) == "MODERATE_DRIFT" and status(8, 20) == "CRITICAL_DRIFT"
    assert status(0, 20, p=0.009) == "MODERATE_DRIFT" and status(0, 20, p=0.01) == "HEALTHY"
    assert status(0, 20, ratio=1.81) == "CRITICAL_DRIFT" and status(0, 20, ratio=1.8) == "HEALTHY"


def test_target_and_residuals(spark):
    base = [(float(i), float(i) + (1 if i % 2 else -1)) for i in range(40)]
    cur = [(float(i), float(i) + (3 if i % 2 else -3)) for i in range(40)]
    schema = "num_orders double, forecast_orders double"
    df = two_sides(spark.createDataFrame(base, schema), spark.createDataFrame(cur, schema), ["num_orders", "forecast_orders"])
    assert drift.residual_variance_ratio(df).first()[0] == pytest.approx(9.0)
    assert drift.target_drift(df).first()[0] == 1.0
    few = two_sides(spark.createDataFrame(base[:5], schema), spark.createDataFrame(cur, schema), ["num_orders"])
    assert drift.target_drift(few).first()[0] is None


def test_report_keeps_the_order_of_the_features(spark):
    base = spark.createDataFrame([(float(i), float(i % 3), float(i)) for i in range(30)], "b double, a double, num_orders double")
    cur = spark.createDataFrame([(float(i + 100), float(i % 3), float(i)) for i in range(30)], "b double, a double, num_orders double")
    report = drift.drift_report(two_sides(base, cur, ["b", "a", "num_orders"]), ["b", "a", "gone"]).first()
    assert [s.name for s in report.scores] == ["b", "a"]
    assert (report.drifted_features, report.features, report.status) == (1, 2, "CRITICAL_DRIFT")
    assert report.scores[0].severity == "HIGH"


def test_half_split_by_week(spark):
    df = spark.range(1, 11).selectExpr("cast(id as int) as week")
    assert rows(split.half_split(df).groupBy("side").count(), "side") == [("baseline", 5), ("current", 5)]


def test_time_split(spark):
    from larder.config import WeekSplit

    df = spark.range(1, 146).selectExpr("cast(id as int) as week")
    a, b, c = split.time_split(df, split=WeekSplit(100, 120))
    assert (a.count(), b.count(), c.count()) == (100, 20, 25)
    with pytest.raises(ValueError):
        split.time_split(df, split=WeekSplit(120, 120))
    with pytest.raises(KeyError):
        split.time_split(df, time="month")


def test_sample_is_stable_and_exact(spark):
    df = spark.range(500).repartition(5)
    first, second = (sorted(rows(split.fixed_sample(df, 40))) for _ in range(2))
    assert first == second and len(first) == 40 and len(rows(split.fixed_sample(df, 900))) == 500


def test_features_without_finite_values_stay_in_the_report(spark):
    data = [("baseline" if k < 20 else "current", float(k % 20), None if k % 2 else float("nan")) for k in range(40)]
    sided = spark.createDataFrame(data, "side string, a double, b double")
    found = {r.feature: r for r in drift.feature_drift(sided, ["a", "b"]).collect()}
    assert set(found) == {"a", "b"} and (found["b"].psi, found["b"].ks_p_value, found["b"].is_drifted) == (0.0, 1.0, False)
    assert drift.drift_status(drift.feature_drift(sided, ["a", "b"])).first().features == 2


def test_missing_demand_price_and_forecast_are_not_numbers(spark):
    clean = [(1, 1, w, 100.0 + 5 * w, 90.0 - 4 * w, 80.0) for w in range(1, 9)]
    schema = "center_id bigint, meal_id int, week int, checkout_price double, num_orders double, forecast_orders double"
    gaps = [(1, 1, 20, 150.0, None, 80.0), (1, 1, 21, None, 50.0, 80.0), (1, 1, 22, float("nan"), 50.0, None)]
    want = profiles.profile_numbers(spark.createDataFrame(clean, schema)).first().elasticity
    got = profiles.profile_numbers(spark.createDataFrame(clean + gaps, schema)).first().elasticity
    assert abs(got - want) < 1e-12
    table = profiles.sku_profiles(spark.createDataFrame(clean, schema))
    out = rows(profiles.adaptive_forecast(spark.createDataFrame(gaps, schema), table).select("week", "adaptive_orders"), "week")
    assert [x is None for _, x in out] == [False, False, True]


@pytest.mark.parametrize("grid", [1, 7, 64, drift.GRID])
def test_grid_counts_give_the_same_measures(spark, grid):
    rng = random.Random(grid)
    names = ["even", "moved", "skewed", "outlier", "ties", "apart", "constant", "one_side", "missing", "huge"]

    def row(i):
        base, x = i % 5 < 3, rng.gauss(0, 1)
        side = "baseline" if base else "current"
        return (
            side, rng.random(), x + (0 if base else 0.3), math.exp(3 * x), 1e300 if i == 7 else x, float(rng.randint(-3, 3)) * 0.0 + rng.randint(0, 4),
            rng.random() - (0 if base else 2), 5.0 if base else 5.0 + (i % 2) * 1e-9, x if base else None, None if i % 3 else float("nan"),
            rng.choice([-1.7e308, 1.7e308, x, -0.0, float("inf")]),
        )

    sided = spark.createDataFrame([row(i) for i in range(1500)], "side string, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    plain, gridded = drift.side_counts(sided, names), drift.drift_counts(sided, names, grid=grid)

    def measures(counts):
        return rows(psi(counts), "feature"), rows(drift.ks_test(counts), "feature")

    (p, k), (gridded_p, gridded_k) = measures(plain), measures(gridded)
    assert gridded_k == k and [f for f, _ in gridded_p] == sorted(names)
    assert [v for _, v in gridded_p] == pytest.approx([v for _, v in p], abs=1e-12)


def test_grid_counts_open_few_cells(spark):
    """20,000 values, 1000 cells: some 20 around the bin edges and those near the largest distance."""
    value = "(id + 0.5) * if(id % 2 = 0, 1.0D, 0.8D) AS v"
    sided = spark.range(20_000).selectExpr("if(id % 2 = 0, 'baseline', 'current') AS side", value)
    assert drift.side_counts(sided, ["v"]).count() > 15_000
    assert drift.drift_counts(sided, ["v"], grid=1000).count() < 3000
