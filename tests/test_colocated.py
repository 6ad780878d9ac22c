"""Series written together: the same results as the plain table, without a shuffle."""

import re

import pytest
from conftest import rows
from panels import store_panel, store_rows
from pyspark.sql import functions as F

from larder.operators.profiles import adaptive_forecast, sku_profiles
from larder.operators.series import history_features
from larder.session import fresh_folder
from larder.sources.colocated import SeriesTable
from larder.sources.staging import stage

KEYS = ["center_id", "meal_id"]


@pytest.fixture(scope="module")
def panel(spark):
    df = store_panel(spark).withColumn("forecast_orders", F.col("num_orders") * 0.9 + 3)
    keyless = df.limit(4).withColumn("center_id", F.lit(None).cast("bigint")).withColumn("id", -F.col("id"))
    return stage(df.unionByName(keyless), "panel")


@pytest.fixture(scope="module")
def table(spark, panel):
    return SeriesTable.write(panel, fresh_folder(spark, "series"), buckets=3)


def shuffles(spark, df):
    """Exchanges in the plan as run, joins being kept from broadcasting."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = df.select("*")  # planned under this setting
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return len(re.findall(r"Exchange", text))


def as_text(df):
    return sorted(map(repr, rows(df.select(*sorted(df.columns)))))


def test_all_rows_are_kept_and_dealt(spark, panel, table):
    assert as_text(table.series().unionByName(table.apart())) == as_text(panel)
    assert table.apart().count() == 4 and table.series().count() == len(store_rows(31))
    files = table.series().inputFiles()
    assert len(files) <= 3 and table.series().rdd.getNumPartitions() > 0


def test_history_needs_no_shuffle(spark, panel, table):
    plain = history_features(panel.filter("center_id IS NOT NULL"), one_row_per_week=True)
    found = history_features(table.series(), one_row_per_week=True)
    assert shuffles(spark, found) == 0 and shuffles(spark, plain) == 1
    assert as_text(found) == as_text(plain)


def test_profiles_and_their_lookup_need_no_shuffle(spark, panel, table):
    found, plain = sku_profiles(table.series()), sku_profiles(panel)
    assert shuffles(spark, found) == 0 and shuffles(spark, plain) > 0
    assert as_text(found) == as_text(plain)
    corrected = adaptive_forecast(table.series(), found)
    assert shuffles(spark, corrected) == 0
    assert as_text(corrected) == as_text(adaptive_forecast(panel.filter("center_id IS NOT NULL"), plain))


def test_a_table_is_opened_again_and_written_once(spark, panel, table):
    again = SeriesTable.open(spark, table.folder)
    assert again.buckets == 3 and again.keys == ("center_id", "meal_id")
    assert as_text(again.series()) == as_text(table.series())
    assert shuffles(spark, sku_profiles(again.series())) == 0
    again.forget()
    assert table.series().count() == len(store_rows(31))
    with pytest.raises(Exception, match="(?i)exist"):
        SeriesTable.write(panel, table.folder, buckets=3)


def test_long_series_are_refused(spark, panel):
    with pytest.raises(ValueError, match="6 series have more than 20 rows"):
        SeriesTable.write(panel, fresh_folder(spark, "series"), light_rows=20)


def test_empty_panel_and_own_keys(spark, panel):
    empty = SeriesTable.write(panel.limit(0), fresh_folder(spark, "series"))
    assert empty.buckets == 1 and empty.series().count() == empty.apart().count() == 0
    single = SeriesTable.write(panel, fresh_folder(spark, "series"), keys=["meal_id"], buckets=2)
    assert shuffles(spark, single.series().groupBy("meal_id").agg(F.sum("num_orders"))) == 0
    assert single.apart().count() == 0
