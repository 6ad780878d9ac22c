import math

import pytest
from conftest import rows

from larder.operators import features as ft

PANEL = (
    "id bigint, week int, center_id bigint, meal_id int, checkout_price double, base_price double, "
    "emailer_for_promotion int, homepage_featured int, center_type string, cuisine string, num_orders double"
)


def test_price_features(spark):
    df = spark.createDataFrame(
        [(1, 80.0, 100.0), (1, 120.0, 100.0), (2, 50.0, None), (2, 30.0, 0.0)],
        "meal_id int, checkout_price double, base_price double",
    )
    out = rows(ft.price_features(df).select("discount_amount", "discount_ratio", "price_ratio"))
    assert out[0] == (20.0, 0.2, 0.8)
    assert out[1] == (0.0, 0.0, 1.2)
    assert out[2] == (None, None, 50.0)  # an unknown base price gives no discount, not a zero one
    assert out[3] == (0.0, 0.0, 300000.0)
    assert ft.price_features(df.drop("base_price")).columns == ["meal_id", "checkout_price"]


def test_relative_price_covers_the_whole_frame_or_a_given_part(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (2, 1, 30.0), (1, None, 5.0)], "week int, meal_id int, checkout_price double").selectExpr(
        "*", "40.0D as base_price"
    )
    assert rows(ft.relative_price(df).select("week", "meal_rel_price"), "meal_rel_price") == [(1, None), (1, 0.5), (2, 1.5)]
    part = ft.relative_price(df, fit_on=df.filter("week = 1")).filter("meal_id = 1")
    assert rows(part.select("meal_rel_price"), "meal_rel_price") == [(1.0,), (3.0,)]


def test_promo_features(spark):
    df = spark.createDataFrame(
        [(1, 1, 80.0, 100.0), (1, 0, 80.0, 100.0), (0, 0, 80.0, 100.0), (None, 1, 80.0, 100.0)],
        "emailer_for_promotion int, homepage_featured int, checkout_price double, base_price double",
    )
    plain = rows(ft.promo_features(df).select("both_promos", "any_promo"))
    assert plain == [(1, 1), (0, 1), (0, 0), (0, 1)]
    assert "promo_discount_synergy" not in ft.promo_features(df).columns
    full = ft.promo_features(ft.price_features(df))
    assert [r[0] for r in rows(full.select("promo_discount_synergy"))] == [0.2, 0.2, 0.0, 0.2]


def test_calendar_features(spark):
    df = spark.createDataFrame([(w,) for w in (1, 13, 14, 26, 52, 53, 0)], "week int")
    out = {r.week: r for r in ft.calendar_features(df).collect()}
    assert [out[w].week_of_year for w in (1, 13, 26, 52, 53, 0)] == [1, 13, 26, 52, 1, 52]
    assert [out[w].month_proxy for w in (1, 13, 53, 0)] == [1, 4, 2, 12]
    assert [out[w].quarter_proxy for w in (13, 14, 53, 0)] == [1, 2, 1, 4]
    assert math.isclose(out[13].sin_week_of_year, 1.0) and math.isclose(out[26].cos_week_of_year, -1.0)


def test_category_codes_sort_natively_and_unseen_is_minus_one(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (100, "b"), (None, None)], "city_code int, cuisine string")
    coded, tables = ft.encode_categories(df, ["city_code", "cuisine", "not_there"])
    assert rows(tables["city_code"], "value") == [(9, 0), (10, 1), (100, 2)]
    assert sorted(rows(coded)) == [(-1, -1), (0, 0), (1, 1), (2, 1)]
    later = spark.createDataFrame([(11, "a")], "city_code int, cuisine string")
    again, _ = ft.encode_categories(later, ["city_code", "cuisine"], tables)
    assert rows(again) == [(-1, 0)]


def test_category_codes_of_many_values(spark):
    df = spark.range(3000).selectExpr("concat('v', cast(id * 7919 % 3000 as string)) as name")
    got = {r.value: r.code for r in ft.category_codes(df, "name").collect()}
    assert got == {v: i for i, v in enumerate(sorted(f"v{i}" for i in range(3000)))}


def _panel(spark):
    return spark.createDataFrame(
        [
            (i, week, center, meal, 90.0, 100.0, 0, 1, "TYPE_A", "Thai", 10.0 * week + center)
            for i, (center, meal, week) in enumerate((c, m, w) for c in (1, 2) for m in (5, 6) for w in range(1, 14))
        ],
        PANEL,
    )


def test_feature_frame_is_complete_and_without_nulls(spark):
    df, names, tables = ft.feature_frame(_panel(spark))
    assert {"id", "num_orders"}.isdisjoint(names) and {"week", "center_id", "meal_id"} <= set(names)
    assert set(tables) == {"center_type", "cuisine"}
    assert df.count() == 52 and df.dropna(subset=names).count() == 52
    raw, _, _ = ft.feature_frame(_panel(spark), impute=False)
    assert raw.filter("num_orders_lag_1 IS NULL").count() == 4


def test_feature_count_with_all_columns(spark):
    wide = _panel(spark).selectExpr("*", "'Pizza' AS category", "500 AS city_code", "30 AS region_code", "2.5D AS op_area")
    _, names, _ = ft.feature_frame(wide)
    assert len(names) == 37


def test_without_target_there_is_no_history(spark):
    _, names, _ = ft.feature_frame(_panel(spark).drop("num_orders"))
    assert not [n for n in names if "lag" in n or "roll" in n]


@pytest.mark.parametrize("how, expected", [("left", 3), ("inner", 1)])
def test_enrich(spark, how, expected):
    fact = spark.createDataFrame([(1, 5), (2, 5), (1, 6)], "center_id bigint, meal_id int")
    centers = spark.createDataFrame([(1, "TYPE_A")], "center_id bigint, center_type string")
    meals = spark.createDataFrame([(5, "Pizza")], "meal_id int, category string")
    assert ft.enrich(fact, centers, meals, how).count() == expected
