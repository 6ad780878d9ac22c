"""The registered queries against their SQL, and the shape of the important plans."""

import glob
import os
import re

import pytest

import __spark_entry__ as entry
from larder.operators.heavy import group_median
from larder.operators.series import history_features
from larder.plans.queries import panel

duckdb = pytest.importorskip("duckdb")
# A cross-section; set LARDER_ALL=1 to compare every query.
SOME = [
    "region_kpis", "violation_report", "enrich_left", "group_median_long_groups", "lag_features_long_series", "rolling_std",
    "category_codes", "metric_suite", "sku_profile", "policy_replay", "feature_drift", "fold_metrics", "sliced_metrics",
    "scenario_outcome", "feedback_stream", "profile_state", "model_comparison", "demand_histogram",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("LARDER_ALL") else SOME


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for file in glob.glob(f"{small}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return connection


def test_registry():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 121


def test_entry_runs(spark, small):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, small, name):
    df = entry.queries()[name](spark, small)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = db.execute(entry.oracle_sql()[name])
    place = [[d[0] for d in cursor.description].index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in place)) for r in cursor.fetchall())


def plan_of(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan")[0]


def test_history_is_one_shuffle_above_the_panel(spark, small):
    df = panel(spark, small)
    extra = history_features(df, one_row_per_week=True)
    count = lambda d: len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange hashpartitioning", plan_of(d)))
    assert count(extra) == count(df) + 1


def test_scan_reads_only_the_needed_columns(spark, small):
    text = plan_of(panel(spark, small).groupBy("week").agg({"num_orders": "sum"}))
    scan = re.search(r"FileScan parquet \[([^\]]*l_quantity[^\]]*)\]", text).group(1)
    assert "l_extendedprice" not in scan and "l_tax" not in scan and "l_returnflag" not in scan


def test_no_python_and_no_nested_loop_in_the_plans(spark, small):
    for name in ("feature_frame", "sku_profile", "feature_drift", "fold_metrics", "policy_replay", "scenario_outcome"):
        text = plan_of(entry.queries()[name](spark, small))
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_median_plan_drops_the_unused_way(spark, small):
    text = plan_of(group_median(panel(spark, small), ["center_id", "meal_id"], "num_orders", "m"))
    assert text.count("FileScan parquet [l_partkey") == 1


def test_training_pipeline_trains_on_the_whole_panel(spark, small, monkeypatch):
    """On the series of every supplier, not on sums by nation, which do not grow with the data."""

    class Seen(Exception):
        pass

    def train(tables, *args, **options):
        raise Seen(tables["train"].count())

    monkeypatch.setattr("larder.plans.training.train", train)
    with pytest.raises(Seen) as seen:
        entry.queries()["training_pipeline"](spark, small)
    assert seen.value.args[0] == panel(spark, small).count()
