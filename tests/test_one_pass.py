"""Checks while loading, folds from counts by bands of weeks, and summaries from the sums of the batches."""

import os

import pytest
from conftest import rows
from panels import store_panel, store_rows
from pyspark.sql import functions as F

from larder.operators import quality
from larder.plans import backtest as bt
from larder.plans.adaptive import FeedbackLog, feedback_summary
from larder.plans.backtest import Walk
from larder.session import fresh_folder
from larder.sources.contracts import CONTRACTS, SchemaError, TableContract
from larder.sources.tables import load_tables
from test_quality import TRAIN, folder


def scans(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_loaded_tables_do_not_read_the_input_again(spark, tmp_path):
    tables = load_tables(spark, folder(tmp_path))
    for name in os.listdir(tmp_path):
        os.truncate(tmp_path / name, 0)
    assert tables["train"].count() == 2 and tables["centers"].count() == 2
    assert "csv" not in scans(tables["train"]).lower()
    lazy = load_tables(spark, folder(tmp_path), validate=False)["train"]
    assert "csv" in scans(lazy).lower()


def test_counts_taken_while_writing_equal_those_of_a_pass(spark):
    contract = CONTRACTS["train"]
    data = [
        (i if i % 7 else None, i, 1, 1, float(i % 5), 2.0, i % 3, 0, float(i - 4) if i % 6 else None) for i in range(40)
    ] + [(1, 1, 1, 1, None, -1.0, None, 9, -0.0)] * 3
    df = spark.createDataFrame(data, contract.struct).repartition(5)
    want = rows(quality.table_violations(df, contract), "check", "column")
    seen = quality.observe_table(df, contract)
    assert rows(seen.violations(), "check", "column") == want and seen.rows == 43
    assert sorted(map(repr, rows(seen.table))) == sorted(map(repr, rows(df)))
    narrow = quality.observe_table(df, contract, ["id"])
    assert narrow.table.columns == ["id"] and rows(narrow.violations(), "check", "column") == want
    with pytest.raises(SchemaError, match="pk_null on 'id': 6 "):
        quality.check_observed(seen)


def test_tries_of_a_task_and_shuffles_below_count_once(spark):
    contract = CONTRACTS["meals"]
    df = spark.range(1000).selectExpr("cast(id % 100 as int) as meal_id", "'a' as category", "'b' as cuisine").distinct()
    seen = quality.observe_table(df.repartition(7), contract)
    assert seen.rows == 100 and {r.violations for r in seen.violations().collect()} == {0}


def test_report_of_empty_keyless_and_foreign_tables(spark):
    empty = spark.createDataFrame([], CONTRACTS["train"].struct)
    report = quality.violation_report({"train": empty, "extra": spark.range(3)})
    assert report.count() == 7 and report.agg(F.sum("violations")).first()[0] == 0
    flags = TableContract("flags", "flags.csv", (), {"on": "int"}, binary=("on",))
    child = TableContract("child", "child.csv", ("k",), {"k": "int", "p": "int"}, foreign_keys={"p": ("parent", "q")})
    parent = TableContract("parent", "parent.csv", (), {"q": "int", "v": "string"})
    tables = {
        "flags": spark.createDataFrame([(0,), (5,), (None,)], "on int"),
        "child": spark.createDataFrame([(1, 1), (1, 2), (None, 3), (4, None)], "k int, p int"),
        "parent": spark.createDataFrame([(1, "a"), (None, "b")], "q int, v string"),
    }
    got = rows(quality.violation_report(tables, {c.name: c for c in (flags, child, parent)}), "table", "check")
    assert got == [("child", "foreign_key", "p", 2), ("child", "pk_duplicate", "k", 1), ("child", "pk_null", "k", 1), ("flags", "not_binary", "on", 1)]


# --- folds -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("expanding", [True, False])
@pytest.mark.parametrize("folds, test_weeks, least", [(2, 4, 10), (5, 3, 4), (3, 6, 2)])
def test_bands_cover_each_folds_weeks_once(spark, expanding, folds, test_weeks, least):
    bounds = bt.fold_bounds(store_panel(spark), Walk(folds, test_weeks, least, expanding))
    bands = bt.train_bands(bounds)
    weeks = [w for start, end, _ in bands for w in range(start, end + 1)]
    assert len(weeks) == len(set(weeks))
    for b in bounds:
        own = [w for start, end, folds in bands if b["fold_index"] in folds for w in range(start, end + 1)]
        assert sorted(own) == list(range(b["train_start"], b["train_end"] + 1))


@pytest.mark.parametrize("expanding", [True, False])
def test_counts_by_bands_equal_a_copy_of_the_rows_per_fold(spark, expanding):
    walk = Walk(3, 3, 5, expanding)
    some = F.when(F.col("week") % 5 == 0, None).when(F.col("week") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("num_orders"))
    keyless = F.when(F.col("week") % 4 == 0, None).otherwise(F.col("center_id"))
    df = store_panel(spark).withColumn("num_orders", some).withColumn("center_id", keyless)
    bounds = bt.fold_bounds(df, walk)
    keys = ["center_id", "meal_id"]
    value = F.when(~F.isnan("num_orders"), F.col("num_orders")).alias("value")
    want = bt.in_folds(df, bounds, "train", walk).groupBy("fold_index", *keys, value).agg(F.count(F.lit(1)).alias("n"))
    got = bt.fold_counts(df, bounds, keys, walk).groupBy("fold_index", *keys, "value").agg(F.sum("weight").alias("n"))
    assert sorted(map(repr, rows(got))) == sorted(map(repr, rows(want)))


def test_no_bounds_and_gaps_between_training_weeks(spark):
    assert bt.fold_counts(store_panel(spark), [], ["center_id"]).count() == 0
    apart = [
        {"fold_index": 1, "train_start": 1, "train_end": 3},
        {"fold_index": 2, "train_start": 8, "train_end": 9},
    ]
    assert bt.train_bands(apart) == [(1, 3, [1]), (8, 9, [2])]
    counts = bt.fold_counts(store_panel(spark), apart, ["center_id", "meal_id"])
    got = dict(rows(counts.groupBy("fold_index").agg(F.sum("weight"))))
    data = store_rows(31)
    assert got == {1: sum(r[1] <= 3 for r in data), 2: sum(8 <= r[1] <= 9 for r in data)}


# --- sums of the log -------------------------------------------------------------------------------


def batch(spark, weeks):
    data = [(w, c, 1, 10.0 * w + c, (10.0 * w if (w + c) % 3 else None)) for w in weeks for c in range(5)]
    return spark.createDataFrame(data, "week int, center_id bigint, meal_id int, forecast_orders double, actual_orders double")


def test_summary_equals_that_of_the_records_and_reads_none(spark):
    log = FeedbackLog(spark, fresh_folder(spark, "log"))
    for number in (1, 2, 3):
        log.record(batch(spark, range(number, number + 3)), number)
    assert rows(log.summary()) == rows(feedback_summary(log.everything()))
    assert all("-sums/" in file for file in log.summary().inputFiles())


def test_a_repeated_batch_replaces_its_sums_and_an_empty_one_nothing(spark):
    log = FeedbackLog(spark, fresh_folder(spark, "log"))
    log.record(batch(spark, [1, 2]), 1)
    log.record(batch(spark, [3]), 2)
    before = rows(log.summary())
    log.record(batch(spark, [1, 2]), 1)
    log.record(batch(spark, []), 2)
    assert rows(log.summary()) == before and log.sums().count() == 2
    log.record(batch(spark, [4, 5, 6]), 2)
    assert log.summary().first().sample_count == log.everything().count() == 25
    assert rows(log.summary()) == rows(feedback_summary(log.everything()))


@pytest.mark.parametrize("limit", [1, 5, 7, 15, 16, 45, 99])
def test_limited_summary_adds_a_part_of_one_batch(spark, limit):
    log = FeedbackLog(spark, fresh_folder(spark, "log"))
    for number in (1, 2, 3):
        log.record(batch(spark, range(number, number + 3)), number)
    newest = FeedbackLog(spark, log.folder, max_history=limit)
    assert newest.read().count() == min(limit, 45)
    assert rows(newest.summary()) == rows(feedback_summary(newest.read()))


def test_a_log_without_sums_gets_them(spark):
    log = FeedbackLog(spark, fresh_folder(spark, "log"))
    log.record(batch(spark, [1, 2]), 1)
    log.sums_folder = fresh_folder(spark, "other-sums")  # as if the log had been written without
    assert rows(log.summary()) == rows(feedback_summary(log.everything()))
    log.record(batch(spark, [3]), 2)
    assert log.sums().count() == 2 and rows(log.summary()) == rows(feedback_summary(log.everything()))


def test_summary_of_a_new_log(spark):
    log = FeedbackLog(spark, fresh_folder(spark, "log"), max_history=3)
    assert log.summary().first().status == "EMPTY" and log.sums().count() == 0
