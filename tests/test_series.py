import random

import pandas as pd
import pytest
from conftest import rows

from larder.operators.series import history_features, lag_features, last_rows, rolling_features

SCHEMA = "id bigint, week int, center_id bigint, meal_id int, num_orders double"


def one_series(spark, weeks_and_values, center=1):
    data = [(i, w, center, 7, v) for i, (w, v) in enumerate(weeks_and_values)]
    return spark.createDataFrame(data, SCHEMA)


def test_lags_skip_missing_weeks(spark):
    df = one_series(spark, [(1, 10.0), (2, 20.0), (9, 30.0)])
    out = rows(lag_features(df, lags=(1, 2)).select("num_orders_lag_1", "num_orders_lag_2", "week"), "week")
    assert out == [(None, None, 1), (10.0, None, 2), (20.0, 10.0, 9)]


def test_rolling_excludes_the_current_row(spark):
    df = one_series(spark, [(1, 10.0), (2, 20.0), (3, 60.0), (4, 0.0)])
    out = rows(rolling_features(df, windows=(3,)).select("num_orders_roll_mean_3", "num_orders_roll_std_3", "week"), "week")
    assert out[0][:2] == (None, 0.0) and out[1][:2] == (10.0, 0.0) and out[2][0] == 15.0 and out[3][0] == 30.0
    assert round(out[3][1], 6) == round(pd.Series([10, 20, 60]).std(), 6)


def test_tied_weeks_follow_the_id(spark):
    df = spark.createDataFrame([(3, 1, 1, 7, 30.0), (1, 1, 1, 7, 10.0), (2, 1, 1, 7, 20.0)], SCHEMA)
    assert rows(lag_features(df, lags=(1,)).select("id", "num_orders_lag_1"), "id") == [(1, None), (2, 10.0), (3, 20.0)]


def test_rows_without_a_key_have_no_history(spark):
    df = spark.createDataFrame([(1, 1, None, 7, 1.0), (2, 2, None, 7, 2.0)], SCHEMA)
    for bounded in (True, False):
        out = history_features(df, lags=(1,), windows=(3,), one_row_per_week=bounded)
        assert rows(out.select("num_orders_lag_1", "num_orders_roll_mean_3")) == [(None, None)] * 2


def test_lag_below_one_is_refused(spark):
    with pytest.raises(ValueError, match="at least 1"):
        lag_features(one_series(spark, [(1, 1.0)]), lags=(0,))


def test_empty_input_keeps_the_columns(spark):
    out = history_features(spark.createDataFrame([], SCHEMA), lags=(1,), windows=(3,))
    assert out.count() == 0
    assert out.columns[-3:] == ["num_orders_lag_1", "num_orders_roll_mean_3", "num_orders_roll_std_3"]


def hot_panel(spark, seed):
    """One series with a third of all rows, many of them in one week, and many short series."""
    rng = random.Random(seed)
    data = []
    for i in range(300):
        data.append((i, 5 if i < 120 else rng.randint(1, 60), 1, 1, float(rng.randint(0, 50))))
    for i in range(300, 900):
        data.append((i, rng.randint(1, 60), rng.randint(2, 40), rng.randint(1, 3), float(rng.randint(0, 50))))
    rng.shuffle(data)
    return spark.createDataFrame(data, SCHEMA).repartition(4), data


@pytest.mark.parametrize("seed, light_rows", [(1, 25), (2, 100)])
def test_cut_series_equal_brute_force(spark, seed, light_rows):
    df, data = hot_panel(spark, seed)
    got = history_features(df, lags=(1, 4, 10), windows=(3, 10), light_rows=light_rows).toPandas()
    want = pd.DataFrame(data, columns=["id", "week", "center_id", "meal_id", "y"]).sort_values(["week", "id"])
    groups = want.groupby(["center_id", "meal_id"])["y"]
    for n in (1, 4, 10):
        want[f"num_orders_lag_{n}"] = groups.shift(n)
    for k in (3, 10):
        before = groups.transform(lambda s: s.shift(1).rolling(k, min_periods=1).mean())
        spread = groups.transform(lambda s: s.shift(1).rolling(k, min_periods=1).std())
        want[f"num_orders_roll_mean_{k}"], want[f"num_orders_roll_std_{k}"] = before, spread.fillna(0.0)
    columns = [c for c in got.columns if "lag" in c or "roll" in c]
    assert len(got) == len(data) and sorted(got.columns) == sorted(["id", "week", "center_id", "meal_id", "num_orders", *columns])
    a, b = got.set_index("id").sort_index()[columns], want.set_index("id").sort_index()[columns]
    pd.testing.assert_frame_equal(a, b, check_dtype=False, atol=1e-9)


def test_pieces_bound_the_window(spark):
    """The hot series really is spread: no piece holds more than a small part of it."""
    from larder.operators.heavy import cut_series

    df, _ = hot_panel(spark, 3)
    cut = cut_series(df, ["center_id", "meal_id"], ["week", "id"], 10, ["num_orders"], light_rows=50, pieces=16)
    sizes = cut.filter("center_id = 1").groupBy("piece").count().toPandas()["count"]
    assert len(sizes) >= 12 and sizes.max() <= 300 / 16 * 2 + 10
    assert cut.filter("center_id <> 1 AND piece > 0").count() == 0


def test_last_rows(spark):
    df, data = hot_panel(spark, 4)
    got = rows(last_rows(df, ["center_id", "meal_id"], ["week", "id"], 3).filter("center_id = 1").select("id", "rank"), "rank")
    hot = sorted(((w, i) for i, w, c, m, _ in data if c == 1), reverse=True)[:3]
    assert got == [(i, r + 1) for r, (_, i) in enumerate(hot)]
