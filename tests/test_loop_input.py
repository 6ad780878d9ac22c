"""The loop takes from the panel what it needs, and looks a batch's profiles up once."""

import re

import pytest
from conftest import rows
from panels import store_panel
from pyspark.sql import functions as F

from larder.operators.forecast import FORECAST, MedianForecaster
from larder.operators.heavy import heavy_groups
from larder.plans import adaptive, queries
from larder.session import fresh_folder
from larder.sources.colocated import SeriesTable


def test_loop_writes_the_test_weeks_only(spark, small, monkeypatch):
    staged, stage = {}, queries.stage
    monkeypatch.setattr(queries, "stage", lambda df, label="stage": staged.setdefault(label, stage(df, label)))
    loop, df = queries._loop(spark, small)
    whole = queries.panel(spark, small)
    later = whole.filter(F.col("week") > queries.SPLIT.val_end)
    assert staged["panel"].count() == later.count() < whole.count()
    assert sorted(rows(df.select(*whole.columns))) == sorted(rows(later))
    fitted = MedianForecaster().fit(whole.filter(F.col("week") <= queries.SPLIT.train_end))
    assert loop.champion.overall == fitted.overall
    assert sorted(rows(loop.champion.medians)) == sorted(rows(fitted.medians))


def test_training_weeks_are_summed_by_their_demand_only(spark, small):
    train = queries.panel(spark, small).filter(F.col("week") <= queries.SPLIT.train_end)
    counted = train.groupBy("center_id", "meal_id", "num_orders").count()
    scan = re.search(r"FileScan parquet \[(l_partkey[^\]]*)\]", counted._jdf.queryExecution().executedPlan().toString()).group(1)
    assert "l_quantity" in scan and "l_extendedprice" not in scan and "l_discount" not in scan


@pytest.mark.parametrize("actual", ["num_orders", "actual_orders"])
def test_a_batch_is_scored_while_it_is_logged(spark, monkeypatch, actual):
    df = store_panel(spark).withColumn("num_orders", F.when(F.col("week") % 7 != 0, F.col("num_orders")))
    df = df.withColumnRenamed("num_orders", actual)
    champion = MedianForecaster(target=actual).fit(df.filter("week <= 20"))
    corrected, _ = adaptive.correct_batch(df, champion, actual)
    want = adaptive.batch_scores(corrected, actual).first()
    monkeypatch.setattr(adaptive, "batch_scores", lambda *a: pytest.fail("the batch is read once more"))
    log = adaptive.FeedbackLog(spark, fresh_folder(spark, "log"))
    result = adaptive.AdaptiveLoop(champion, log).process(df, actual)
    assert (result.champion_wmape, result.adaptive_wmape, result.improvement_pct) == tuple(want)
    assert log.everything().count() == df.count()


def test_scores_of_a_batch_without_pairs(spark):
    df = store_panel(spark, 5).withColumn(FORECAST, F.lit(None).cast("double")).withColumn("adaptive_orders", F.col(FORECAST))
    sums = df.agg(*adaptive.both_sums()).first().asDict()
    assert tuple(adaptive.observed_scores(spark, sums).first()) == tuple(adaptive.batch_scores(df).first()) == (0.0, 0.0, 0.0)


def test_light_groups_are_not_counted_one_by_one(spark):
    df = spark.range(40_000).select((F.col("id") % 10_000).alias("k"), F.lit(None).cast("int").alias("gap"))
    found = heavy_groups(df, ["k", "gap"])
    assert found.collect() == []
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "hashpartitioning(k" not in final
    mixed = df.filter("k < 3").unionByName(df.filter("k = 7 OR k = 8")).unionByName(df.filter("k = 7"))
    assert rows(heavy_groups(mixed, ["k"], 4, [F.max("k").alias("most")]), "k") == [(7, 8, 7)]


def test_series_are_written_before_the_forecast_is_looked_up(spark, small, monkeypatch):
    written, write = [], SeriesTable.write
    monkeypatch.setattr(queries.SeriesTable, "write", lambda df, folder: written.append(df) or write(df, folder))
    found = queries.QUERIES["sku_profile_colocated"](spark, small)
    assert FORECAST not in written[0].columns and "Join" not in written[0]._jdf.queryExecution().executedPlan().toString()
    assert sorted(rows(found)) == sorted(rows(queries.QUERIES["sku_profile"](spark, small)))
