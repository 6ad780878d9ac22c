import pytest
from conftest import rows

from larder.operators import quality
from larder.sources.contracts import CONTRACTS, DataContractError, RelationshipError, SchemaError
from larder.sources.tables import load_tables

HEAD = "id,week,center_id,meal_id,checkout_price,base_price,emailer_for_promotion,homepage_featured,num_orders"
TRAIN = [HEAD, "1,1,10,100,120.0,150.0,0,0,50", "2,1,11,101,90.5,100.0,1,0,"]
CENTERS = ["center_id,city_code,region_code,center_type,op_area", "10,500,30,TYPE_A,2.5", "11,501,31,TYPE_B,3.0"]
MEALS = ["meal_id,category,cuisine", "100,Beverages,Thai", "101,Pizza,Italian"]


def folder(tmp_path, train=TRAIN, centers=CENTERS, meals=MEALS, test=None):
    files = {"train.csv": train, "fulfilment_center_info.csv": centers, "meal_info.csv": meals, "test.csv": test}
    for name, lines in files.items():
        if lines is not None:
            (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def changed(line, text):
    return [*TRAIN[:line], text, *TRAIN[line + 1 :]]


def test_load_checks_and_types(spark, tmp_path):
    tables = load_tables(spark, folder(tmp_path))
    assert sorted(tables) == ["centers", "meals", "train"]
    assert dict(tables["train"].dtypes)["num_orders"] == "double"
    assert rows(tables["train"].select("id", "num_orders"), "id") == [(1, 50.0), (2, None)]


def test_columns_are_matched_by_name(spark, tmp_path):
    swapped = ["cuisine,meal_id,category", "Thai,100,Beverages", "Italian,101,Pizza"]
    tables = load_tables(spark, folder(tmp_path, meals=swapped))
    assert rows(tables["meals"].select("meal_id", "cuisine"), "meal_id") == [(100, "Thai"), (101, "Italian")]


def test_optional_test_table(spark, tmp_path):
    test = [HEAD.replace(",num_orders", ""), "9,146,10,100,1.0,1.0,0,0"]
    place = folder(tmp_path, test=test)
    assert "test" in load_tables(spark, place)
    assert "test" not in load_tables(spark, place, include_test=False)


def test_mandatory_table_missing(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="meal_info"):
        load_tables(spark, folder(tmp_path, meals=None))


@pytest.mark.parametrize(
    "train, error, text",
    [
        (changed(2, "1,1,11,101,90.5,100.0,1,0,5"), SchemaError, "pk_duplicate on 'id': 1 "),
        (changed(2, ",1,11,101,90.5,100.0,1,0,5"), SchemaError, "pk_null"),
        (changed(2, "2,1,11,101,90.5,100.0,2,0,5"), SchemaError, "not_binary"),
        (changed(2, "2,1,11,101,0,100.0,1,0,5"), SchemaError, "not_positive on 'checkout_price'"),
        (changed(2, "2,1,11,101,90.5,100.0,1,0,-5"), SchemaError, "negative on 'num_orders'"),
        (changed(2, "2,1,99,101,90.5,100.0,1,0,5"), RelationshipError, r"1 key\(s\) not found in 'centers', for example \[99\]"),
        (changed(2, "2,1,11,999,90.5,100.0,1,0,5"), RelationshipError, "'meals'"),
        (changed(2, "2,1,11,101,90.5,100.0,0.5,0,5"), DataContractError, "whole number"),
        (changed(2, "2,1,11,101,cheap,100.0,1,0,5"), DataContractError, "cannot read"),
        ([HEAD.replace(",week", ""), "1,10,100,1.0,1.0,0,0,5"], SchemaError, "missing required columns: \\['week'\\]"),
    ],
)
def test_broken_tables(spark, tmp_path, train, error, text):
    place = folder(tmp_path, train=train)
    with pytest.raises(error, match=text):
        load_tables(spark, place)
    if error is not SchemaError or "missing" not in text:
        assert load_tables(spark, place, validate=False)


def test_strict_columns(spark):
    meals = spark.createDataFrame([(1, "a", "b", 0)], "meal_id int, category string, cuisine string, extra int")
    quality.check_table(meals, CONTRACTS["meals"])
    with pytest.raises(SchemaError, match="extra"):
        quality.check_table(meals, CONTRACTS["meals"], strict=True)
    with pytest.raises(ValueError, match="price"):
        quality.require_columns(meals, ["meal_id", "price"])


def test_empty_table_passes_and_report_lists_every_rule(spark):
    empty = spark.createDataFrame([], CONTRACTS["train"].struct)
    quality.check_table(empty, CONTRACTS["train"])
    report = quality.violation_report({"train": empty})
    assert report.count() == 7 and report.filter("violations > 0").count() == 0


def test_unmapped_sample_is_the_smallest_five(spark):
    child = spark.range(100, 120).selectExpr("id as k").union(spark.range(3).selectExpr("cast(null as bigint) as k"))
    parent = spark.range(100, 103).selectExpr("id as k")
    missing = quality.unmapped_keys(child, parent, "k")
    assert missing.count() == 17
    assert [r.key for r in quality.unmapped_sample(missing).collect()] == [103, 104, 105, 106, 107]
