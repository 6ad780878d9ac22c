import math

import pytest
from conftest import rows

from larder.config import StockPolicy
from larder.functions import scores, stock
from larder.functions.numbers import half_up
from larder.operators import inventory
from larder.operators.forecast import MedianForecaster, compare, score
from larder.operators.slices import sliced_scores

PAIR = "num_orders double, forecast_orders double"
INF, NAN = float("inf"), float("nan")


def measure(spark, pairs):
    return score(spark.createDataFrame(pairs, PAIR)).first().asDict()


def test_known_measures(spark):
    out = measure(spark, [(100.0, 110.0), (200.0, 190.0), (300.0, 330.0)])
    assert out["wmape"] == 0.0833 and out["mae"] == 16.667 and out["rmse"] == 19.149


def test_empty_and_zero_actuals(spark):
    assert set(measure(spark, []).values()) == {0.0}
    assert measure(spark, [(0.0, 5.0)])["wmape"] == 0.0


def test_only_finite_pairs_count(spark):
    out = measure(spark, [(10.0, 12.0), (NAN, 5.0), (7.0, INF), (None, 1.0), (4.0, None), (INF, 2.0), (3.0, NAN)])
    assert (out["mae"], out["wmape"]) == (2.0, 0.2)


def test_forecasts_are_clipped_before_the_finite_check(spark):
    assert measure(spark, [(10.0, -INF)])["mae"] == 10.0
    assert measure(spark, [(10.0, -4.0)])["mae"] == 10.0


def test_single_measures(spark):
    df = spark.createDataFrame([(10.0, -5.0), (-3.0, 1.0)], PAIR)
    got = df.select(scores.wmape("num_orders", "forecast_orders"), scores.rmsle("num_orders", "forecast_orders")).first()
    assert got[0] == pytest.approx(19 / 13)
    assert got[1] == pytest.approx(math.sqrt((math.log1p(10) ** 2 + math.log1p(1) ** 2) / 2))


def test_rounding_is_half_up_on_the_decimal(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (-0.125,), (1.005,)], "v double")
    assert [r[0] for r in rows(df.select(half_up("v", 2)))] == [2.68, 0.13, -0.13, 1.01]


def test_median_forecaster(spark):
    train = spark.createDataFrame(
        [(1, 1, 100.0), (1, 1, 110.0), (1, 1, 120.0), (1, 2, 50.0), (1, 2, 70.0), (None, 2, 1000.0)],
        "center_id bigint, meal_id int, num_orders double",
    )
    model = MedianForecaster().fit(train)
    new = spark.createDataFrame([(1, 1), (1, 2), (9, 9), (None, 2)], "center_id bigint, meal_id int")
    got = {(r.center_id, r.meal_id): r.forecast_orders for r in model.transform(new).collect()}
    assert got == {(1, 1): 110.0, (1, 2): 60.0, (9, 9): 105.0, (None, 2): 105.0}
    assert model.evaluate(train).first().mae > 0


def test_median_forecaster_edge_cases(spark):
    schema = "center_id bigint, meal_id int, num_orders double"
    empty = MedianForecaster().fit(spark.createDataFrame([], schema))
    new = spark.createDataFrame([(1, 1, 3.0)], schema)
    assert empty.transform(new).first().forecast_orders == 0.0
    negative = MedianForecaster().fit(spark.createDataFrame([(1, 1, -5.0)], schema))
    assert negative.transform(new).first().forecast_orders == 0.0
    no_keys = MedianForecaster().fit(spark.createDataFrame([(4.0,), (8.0,)], "num_orders double"))
    assert no_keys.transform(new).first().forecast_orders == 6.0


def test_comparison_gain(spark):
    a = spark.createDataFrame([(10.0, 5.0)], PAIR)
    b = spark.createDataFrame([(10.0, 9.0)], PAIR)
    got = {r.model: r.gain_pct for r in compare({"a": a, "b": b}, "a").collect()}
    assert got == {"a": 0.0, "b": 80.0}


@pytest.mark.parametrize(
    "level, z", [(0.95, 1.6449), (0.99, 2.3263), (0.8, 0.8416), (0.97, 1.6449), (0.5, 0.8416), (0.999, 2.3263), (0.951, 1.6449)]
)
def test_z_score(spark, level, z):
    assert stock.z_score(level) == z
    assert spark.range(1).select(stock.z_score_of(__import__("pyspark").sql.functions.lit(level))).first()[0] == z


def test_safety_stock(spark):
    df = spark.createDataFrame([(10.0,), (1.0,), (None,)], "std double")
    assert [r[0] for r in rows(df.select(stock.safety_stock("std")))] == [17.0, 5.0, None]
    lead = stock.safety_stock("std", StockPolicy(lead_time_weeks=4))
    assert df.select(lead).first()[0] == 33.0


PLAN = "center_id bigint, meal_id int, forecast_orders double, current_stock double"


def test_plan_and_totals(spark):
    df = spark.createDataFrame([(1, 1, 150.0, 20.0), (1, 2, 80.0, 100.0)], PLAN)
    plan = inventory.stock_plan(df, std=15.0, on_hand="current_stock")
    assert [r.recommended_preparation for r in plan.orderBy("meal_id").collect()] == [155.0, 5.0]
    total = inventory.plan_totals(plan).first()
    assert total.total_forecasted_units == 230.0 and total.total_safety_stock_buffer_units == 50.0
    assert total.buffer_overhead_percentage == 21.74
    assert inventory.stock_plan(df, std=15.0).first().recommended_preparation == 175.0


def test_empty_plan_and_missing_forecast(spark):
    plan = inventory.stock_plan(spark.createDataFrame([], PLAN))
    assert {"safety_stock", "reorder_point", "recommended_preparation"} <= set(plan.columns)
    assert tuple(inventory.plan_totals(plan).first()) == (0.0, 0.0, 0.0, 0.0)
    with pytest.raises(KeyError):
        inventory.stock_plan(plan, forecast="no_such_column")


def test_recommend_rows(spark):
    df = spark.createDataFrame([(100.0, 10.0, 50.0), (10.0, 10.0, 500.0)], "f double, s double, h double")
    out = rows(inventory.recommend(df, "f", "s", "h").select("safety_stock", "recommended_preparation", "reorder_point"))
    assert out == [(17.0, 67.0, 117.0), (17.0, 0.0, 27.0)]


REPLAY = "week int, forecast_orders double, actual_orders double"


def test_policy_replay(spark):
    df = spark.createDataFrame([(1, 100.0, 120.0), (2, 150.0, 130.0), (3, 200.0, 260.0), (4, 50.0, 60.0)], REPLAY)
    replay = inventory.policy_replay(df, std=20.0)
    report = {r.service_level: r for r in inventory.replay_report(replay).collect()}
    assert len(report) == 6 and {r.total_demand_units for r in report.values()} == {570.0}
    low = report[0.8]  # buffer 17
    assert low.total_stockout_units == 3.0 + 43.0 and low.stockout_event_rate == 50.0
    assert low.total_wasted_units == round((37 + 7) * 0.3, 1)
    assert low.total_operational_cost == pytest.approx(13.2 * 5 + 46 * 160)
    assert inventory.best_policy(replay).first()[0] == 0.99


def test_policy_ties_take_the_first_and_empty_input_takes_the_usual(spark):
    df = spark.createDataFrame([(1, 0.0, 1000.0)], REPLAY)
    assert inventory.best_policy(inventory.policy_replay(df, std=0.0)).first()[0] == 0.8
    none = inventory.policy_replay(df.limit(0))
    assert none.count() == 0 and inventory.best_policy(none).first()[0] == 0.95


def test_policy_rows_add_up_to_the_replay(spark):
    df = spark.createDataFrame([(w, 10.0 * w, 15.0 * (w % 7)) for w in range(1, 40)], REPLAY)
    by_rows = inventory.policy_rows(df).groupBy("service_level").sum("stockout", "wasted")
    want = {r.service_level: (r.total_stockout_units, r.total_wasted_units) for r in inventory.policy_replay(df).collect()}
    for level, stockout, wasted in rows(by_rows):
        assert want[level] == (pytest.approx(stockout), pytest.approx(wasted, abs=0.05))


def test_slices_need_five_rows(spark):
    data = [("A", 1, 10.0, 8.0)] * 5 + [("B", 0, 10.0, 10.0)] * 4 + [(None, 0, 10.0, 10.0)] * 5
    df = spark.createDataFrame(data, "center_type string, homepage_featured int, num_orders double, forecast_orders double")
    got = {(r.dimension, r.slice): (r.sample_count, r.mae) for r in sliced_scores(df).collect()}
    assert got == {("center_type", "A"): (5, 2.0), ("homepage_featured", "1"): (5, 2.0), ("homepage_featured", "0"): (9, 0.0)}


def test_replay_scores_only_rows_with_demand_and_forecast(spark):
    data = [(100.0, 110.0), (None, 40.0), (60.0, None), (float("nan"), 5.0)]
    df = spark.createDataFrame(data, "forecast_orders double, actual_orders double")
    for r in inventory.replay_report(inventory.policy_replay(df)).collect():
        assert r.unscored_rows == 3 and r.total_demand_units == 110.0 and 0 <= r.fill_rate_percentage <= 100
    missing = inventory.policy_rows(df).filter("actual_orders IS NULL OR forecast_orders IS NULL")
    assert missing.filter("fulfilled IS NOT NULL OR stockout IS NOT NULL OR wasted IS NOT NULL").count() == 0
