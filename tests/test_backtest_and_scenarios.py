import pytest
from conftest import rows
from panels import store_panel, store_rows

from larder.operators import scenarios
from larder.operators.elastic import ProfileForecaster
from larder.operators.forecast import Forecaster, MedianForecaster
from larder.plans import backtest as bt
from larder.plans.backtest import Walk

WALK = Walk(folds=2, test_weeks=4, min_train_weeks=10)


def test_fold_bounds_and_samples(spark):
    df = store_panel(spark)
    got = rows(bt.fold_table(df, WALK), "fold_index")
    assert got == [(1, 1, 23, 24, 27), (2, 1, 27, 28, 31)]
    sliding = rows(bt.fold_table(df, Walk(2, 4, 10, expanding=False)), "fold_index")
    assert sliding == [(1, 14, 23, 24, 27), (2, 18, 27, 28, 31)]


@pytest.mark.parametrize("weeks, width", [(33, 7), (22, 4), (14, 2), (9, 2)])
def test_window_shrinks_for_short_histories(spark, weeks, width):
    first = bt.fold_table(store_panel(spark, weeks), Walk(3, 10, 10)).first()
    assert first.test_end - first.test_start + 1 == width


def test_median_plan_equals_the_fold_loop(spark):
    df = store_panel(spark)
    one_plan, loop = bt.backtest(df, walk=WALK), bt.backtest(df, MedianForecaster, walk=WALK)
    for part in ("folds", "overall", "slices"):
        a, b = getattr(one_plan, part), getattr(loop, part)
        assert sorted(rows(a.select(*sorted(a.columns)))) == sorted(rows(b.select(*sorted(b.columns))))
    tested = [r for r in store_rows(31) if r[1] >= 24]
    assert one_plan.predictions.count() == len(tested)
    fold = one_plan.folds.orderBy("fold_index").first()
    assert fold.train_samples == sum(r[1] <= 23 for r in store_rows(31))
    assert fold.test_samples == sum(r[1] <= 27 for r in tested)
    assert {r.dimension for r in one_plan.slices.collect()} == {
        "center_type", "category", "cuisine", "emailer_for_promotion", "homepage_featured"
    }


def test_gap_folds_are_skipped_and_no_fold_is_an_error(spark):
    df = store_panel(spark).filter("week < 24 OR week > 27")
    assert [r.fold_index for r in bt.backtest(df, walk=WALK).folds.collect()] == [2]
    with pytest.raises(ValueError, match="no fold"):
        bt.backtest(store_panel(spark, 1), walk=WALK)
    with pytest.raises(ValueError, match="no fold"):
        bt.backtest(store_panel(spark, 1), MedianForecaster, walk=WALK)


class OwnModel(Forecaster):
    """What a user may plug in."""

    def fit(self, df, validation=None):
        self.level = df.agg({"num_orders": "avg"}).first()[0]
        return self

    def transform(self, df):
        from pyspark.sql import functions as F

        return df.withColumn("forecast_orders", F.lit(self.level))


def test_any_forecaster_can_be_backtested(spark):
    assert bt.backtest(store_panel(spark), OwnModel, walk=WALK).overall.first().mae > 5


# --- scenarios -------------------------------------------------------------------------------------


def test_scenarios_change_only_their_columns(spark):
    df = store_panel(spark, 1).filter("any_promo = 0").limit(1)
    base = df.first().asDict()
    changed = {
        r.scenario: {k: v for k, v in r.asDict().items() if k != "scenario" and v != base[k]}
        for r in scenarios.all_scenarios(df).collect()
    }
    price = base["checkout_price"]
    assert changed["base"] == {}
    assert changed["price_surge"] == {"checkout_price": price * 1.3, "price_ratio": base["price_ratio"] * 1.3}
    assert changed["flash_sale"] == {"checkout_price": price * 0.65, "discount_ratio": base["discount_ratio"] + 0.35}
    assert changed["promo_blitz"] == dict.fromkeys(
        ("emailer_for_promotion", "homepage_featured", "both_promos", "any_promo"), 1
    )
    assert changed["blackout"] == {}
    promoted = scenarios.apply_scenario(scenarios.apply_scenario(df, "promo_blitz"), "blackout").first()
    assert (promoted.both_promos, promoted.any_promo, promoted.promo_discount_synergy) == (0, 0, 0.0)


def test_single_and_joint_scenarios_agree(spark):
    df = store_panel(spark, 3)
    joint = scenarios.all_scenarios(df)
    for s in scenarios.SCENARIOS:
        want = sorted(rows(scenarios.apply_scenario(df, s.key)))
        assert sorted(rows(joint.filter(joint.scenario == s.key).drop("scenario"))) == want


def test_discount_is_capped_and_missing_columns_are_skipped(spark):
    df = spark.createDataFrame([(100.0, 0.8), (100.0, None)], "checkout_price double, discount_ratio double")
    out = rows(scenarios.apply_scenario(df, "flash_sale"))
    assert out == [(65.0, 0.9), (65.0, None)]
    assert rows(scenarios.apply_scenario(df, "promo_blitz")) == rows(df)


def outcome(spark, totals):
    df = spark.createDataFrame([(k, float(v), 0.0, 0.0) for k, v in totals.items()], "scenario string, total double, prep double, buffer double")
    return scenarios.scenario_outcomes(df)


def test_directions_and_verdict(spark):
    fine = {"base": 100, "price_surge": 105, "flash_sale": 95, "promo_blitz": 120, "blackout": 90}
    out = outcome(spark, fine)
    assert [r.direction_valid for r in out.collect()] == [True] * 4
    assert scenarios.stress_verdict(out).first()[0].startswith("PASSED")
    bad = outcome(spark, {**fine, "price_surge": 105.1, "flash_sale": 94.9})
    assert {r.scenario_name: r.direction_valid for r in bad.collect()}["Price Surge (+30%)"] is False
    assert bad.filter("NOT direction_valid").count() == 2
    assert scenarios.stress_verdict(bad).first()[0].startswith("CAUTION")


def test_stress_test_end_to_end(spark):
    df = store_panel(spark)
    got = {r.scenario_name: r for r in scenarios.stress_test(df, ProfileForecaster().fit(df)).collect()}
    assert len(got) == 4 and all(r.direction_valid for r in got.values())
    assert got["Promotion Blackout"].percentage_change < 0 < got["Promotional Blitz (Email + Homepage)"].percentage_change
    assert got["Promotion Blackout"].buffer_overhead_units == 33.0 * df.count()


def test_weekly_histogram_and_skewness(spark):
    from larder.operators import explore

    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0), (2, 7.0), (2, None)], "week int, num_orders double")
    assert rows(explore.weekly_demand(df), "week") == [(1, 3.0), (2, 10.0)]
    bins = rows(explore.histogram(df, "num_orders", 3).select("bin", "low", "rows"), "bin")
    assert bins == [(0, 1.0, 2), (1, 3.0, 1), (2, 5.0, 1)]
    constant = explore.histogram(df.filter("num_orders = 3"), "num_orders", 4)
    assert [r["rows"] for r in constant.orderBy("bin").collect()] == [1, 0, 0, 0]
    assert round(explore.demand_skewness(df).first().raw_skewness, 3) == 1.443


def test_a_panel_without_slice_columns_can_be_backtested(spark):
    df = store_panel(spark).select("id", "week", "center_id", "meal_id", "num_orders")
    out = bt.backtest(df, walk=WALK)
    assert out.slices.count() == 0 and "wmape" in out.slices.columns and out.overall.first().mae > 0
