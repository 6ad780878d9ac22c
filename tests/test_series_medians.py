"""The loop's median gathers the weeks of a series in one shuffle."""

import pytest
from conftest import rows
from panels import store_panel
from pyspark.sql import functions as F

from larder.operators import forecast
from larder.operators.forecast import MedianForecaster
from larder.plans import queries

KEYS = ["center_id", "meal_id"]


def test_loop_writes_a_series_as_one_row(spark, small, monkeypatch):
    staged, stage = [], forecast.stage
    monkeypatch.setattr(forecast, "stage", lambda df, label="stage": staged.append(stage(df, label)) or staged[-1])
    queries._loop(spark, small)
    train = queries.panel(spark, small).filter(F.col("week") <= queries.SPLIT.train_end)
    series = train.select(*KEYS).distinct().count()
    assert series < train.count()
    by_series = [df for df in staged if set(KEYS) <= set(df.columns)]
    assert by_series and all(df.count() == series for df in by_series)


@pytest.mark.parametrize("weeks", ["week <= 20", "week < 0"])
def test_medians_by_week_equal_the_counted_ones(spark, weeks):
    df = store_panel(spark).filter(weeks).withColumn(
        "num_orders",
        F.when(F.col("week") % 7 == 0, F.lit(float("nan")))
        .when((F.col("week") % 5 != 0) & (F.col("meal_id") % 3 != 0), F.col("num_orders").cast("double") / 3),
    )
    df = df.withColumn("center_id", F.when(F.col("week") % 4 != 1, F.col("center_id")))
    df = df.unionByName(df.limit(1).withColumns({"meal_id": F.lit(999), "num_orders": F.lit(None).cast("double")}))
    plain, weekly = MedianForecaster().fit(df), MedianForecaster(one_row_per_week=True).fit(df)
    assert weekly.overall == plain.overall
    assert rows(weekly.medians, *KEYS) == rows(plain.medians, *KEYS)
    assert weekly.medians.count() > 0 or weeks == "week < 0"
