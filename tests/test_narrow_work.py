"""What is shuffled and written is narrow: whole numbers, base columns, each table once."""

import random
from glob import glob

import pytest
from conftest import rows
from panels import store_panel
from pyspark.sql import functions as F

from larder.operators import features as ft
from larder.operators.forecast import MedianForecaster
from larder.operators.heavy import exact_quantiles
from larder.plans import queries, training
from larder.sources import artifacts, star


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hundredths_equal_the_decimal_cast(spark):
    rng = random.Random(5)
    values = [0.0, -0.0, 0.29, 1.005, -1.005, 2.675, 1e-9, 0.994999, 1e13 + 0.01, 123456789012.34, None]
    values += [rng.randint(-(10**9), 10**9) / 100 for _ in range(200)] + [rng.uniform(-50, 50) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = (F.col("v").cast("decimal(18,2)") * 100).cast("bigint")
    assert df.filter(~star.hundredths("v", 18).eqNullSafe(want)).count() == 0


@pytest.mark.parametrize("total, digits", [(12345, 2), (2**53 + 1, 4), (2**62 + 12345, 4), (-(2**60) - 7, 2), (0, 4)])
def test_sums_become_the_nearest_double(spark, total, digits):
    got = spark.range(1).select(star._decimal_sum(F.lit(total), digits)).first()[0]
    assert got == total / 10**digits


def test_panel_shuffle_carries_no_decimals_or_names(spark, small):
    exchanges = [line for line in physical(star.demand_panel(spark, small)).splitlines() if "Aggregate(keys=[week" in line]
    assert exchanges and not [line for line in exchanges if "p_type" in line or "decimal" in line]


def test_history_is_shuffled_without_features_and_metadata(spark):
    panel = store_panel(spark).drop("center_type", "category", "cuisine", "discount_ratio", "price_ratio", "both_promos", "any_promo", "promo_discount_synergy")
    centers = spark.createDataFrame([(3, "CITY"), (8, "ROAD"), (21, "CITY")], "center_id bigint, center_type string")
    meals = spark.createDataFrame([(7, "Soup"), (9, "Salad")], "meal_id int, category string")
    frame, names, _ = ft.feature_frame(panel, one_row_per_week=True, metadata=(centers, meals))
    lines = physical(frame).splitlines()
    at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(center_id" in line and "Window" in "".join(lines[:i]))
    carried = lines[at + 1]
    assert "num_orders" in carried
    assert "discount_ratio" not in carried and "sin_week_of_year" not in carried and "center_type" not in carried
    joined, same, _ = ft.feature_frame(ft.enrich(panel, centers, meals), one_row_per_week=True)
    assert names == same and frame.columns == joined.columns and names[-1].startswith("num_orders_roll")
    assert sorted(map(str, rows(frame))) == sorted(map(str, rows(joined)))


def test_features_are_written_from_where_they_are(spark, tmp_path):
    folder = str(tmp_path / "features")
    artifacts.write_features(store_panel(spark, 9).repartition(3), folder)
    assert len(glob(f"{folder}/week_bucket=0/*.parquet")) == 3
    assert artifacts.read_features(spark, folder).count() == store_panel(spark, 9).count()


def test_medians_take_one_window(spark):
    counts = spark.createDataFrame([(1, 2.0, 3), (1, 5.0, 1), (2, 4.0, 2)], "k int, value double, weight bigint")
    found = exact_quantiles(counts, ["k"], [0.5])
    assert rows(found, "k") == [(1, [2.0]), (2, [4.0])]
    # One for the light groups; piece totals and the pieces around a wanted position have one each.
    assert physical(found).count("Window [") == 3


def test_median_run_fits_its_median_once(spark, small, monkeypatch):
    fits = []
    fit = MedianForecaster.fit
    monkeypatch.setattr(MedianForecaster, "fit", lambda self, df, validation=None: fits.append(1) or fit(self, df, validation))
    tables = star.star_tables(spark, small, "region")
    result = training.train(tables, queries.SETTINGS, forecaster=MedianForecaster(), one_row_per_week=True)
    assert len(fits) == 1 and rows(result.baseline_metrics) == rows(result.model_metrics)


def test_loop_stages_the_panel_only(spark, small, monkeypatch):
    staged = {}
    stage = queries.stage
    monkeypatch.setattr(queries, "stage", lambda df, label="stage": staged.update({label: df.columns}) or stage(df, label))
    _, df = queries._loop(spark, small)
    assert "any_promo" in df.columns and "any_promo" not in staged["panel"]
