"""The demand panel derived from the star-schema test tables.

One panel row is one (week, center, meal). ``grain`` chooses what a center is: a supplier (the panel
then grows with the data), a nation or a region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAINS = ("supplier", "nation", "region")
FIRST_MEAL = 100
CUISINES = ("Indian", "Italian", "Continental", "Thai")


# The columns used here; stating them saves the pass over file footers that would infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_type string",
    "lineitem": "l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_discount double, "
    "l_returnflag string, l_shipdate timestamp_ntz",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder.rstrip('/')}/{table}.parquet")


def part_types(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct part types; a handful of values fixed by the schema of ``part``."""
    return read(spark, folder, "part").select("p_type").distinct()


def meal_number(spark: SparkSession, folder: str) -> Column:
    """100 + position of the part type among the sorted distinct types, as a scalar subquery."""
    types = part_types(spark, folder).agg(F.sort_array(F.collect_set("p_type")).alias("types")).scalar()
    return (F.lit(FIRST_MEAL - 1) + F.array_position(types, F.col("p_type"))).cast("int")


def hundredths(c: str, precision: int) -> Column:
    """A double as a whole number of hundredths, rounded like its cast to ``decimal(precision, 2)``.

    Values with two digits, which up to 15 digits a double holds apart, need no decimal; all others go through one.
    """
    value = F.col(c)
    near = F.rint(value * 100)
    plain = (F.abs(near) < F.lit(10.0 ** min(precision, 15))) & (near / 100 == value)
    return F.when(plain, near.cast("bigint")).otherwise((value.cast(f"decimal({precision},2)") * 100).cast("bigint"))


def _decimal_sum(total: Column, digits: int) -> Column:
    """The double next to ``total`` shifted by ``digits``; whole numbers up to 2**53 are exact doubles themselves."""
    exact = (total.cast("decimal(20,0)") * F.lit(f"1e-{digits}").cast(f"decimal({digits},{digits})")).cast("double")
    return F.when(F.abs(total) < F.lit(2**53), total.cast("double") / F.lit(10.0**digits)).otherwise(exact)


def demand_panel(spark: SparkSession, folder: str, grain: str = "supplier") -> DataFrame:
    """The ``train`` table: weekly price, promotion flags and demand per center and meal.

    Only the needed columns are read. Sums run over whole hundredths (prices less discount: ten-thousandths), so the
    result does not depend on the order of the rows and a group is a few fixed-width numbers in the shuffle; a sum beyond
    9 * 10**18 of them is an error in Spark's ANSI mode. The aggregation combines on the map side, hence a hot supplier
    or part type reaches the shuffle as one row per week and task.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")
    lines = read(spark, folder, "lineitem").select(
        (F.floor(F.datediff("l_shipdate", F.lit("1995-01-01").cast("date")) / 7) + 1).cast("int").alias("week"),
        "l_partkey",
        F.col("l_suppkey").alias("center_id"),
        hundredths("l_quantity", 18).alias("q"),
        hundredths("l_extendedprice", 18).alias("e"),
        hundredths("l_discount", 4).alias("disc"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
    )
    # The number of a type, not its name, so that the shuffles carry no strings.
    meal = meal_number(spark, folder).alias("meal_id")
    parts = read(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), meal)
    lines = lines.join(parts, "l_partkey")
    if grain != "supplier":
        lines = (
            lines.join(
                read(spark, folder, "supplier").select(F.col("s_suppkey").alias("center_id"), "s_nationkey"),
                "center_id",
            )
            .drop("center_id")
            .withColumnRenamed("s_nationkey", "center_id")
        )
    if grain == "region":
        # nation has one row per nation, a few dozen by definition
        nations = read(spark, folder, "nation").select(F.col("n_nationkey").alias("center_id"), "n_regionkey")
        lines = lines.join(nations, "center_id").drop("center_id").withColumnRenamed("n_regionkey", "center_id")
    q = _decimal_sum(F.sum("q"), 2)
    weekly = lines.groupBy("week", "center_id", "meal_id").agg(
        (_decimal_sum(F.sum(F.col("e") * (100 - F.col("disc"))), 4) / q).alias("checkout_price"),
        (_decimal_sum(F.sum("e"), 2) / q).alias("base_price"),
        (10 * F.sum("disc") >= 55 * F.count(F.lit(1))).cast("int").alias("emailer_for_promotion"),
        (10 * F.sum("returned") >= 4 * F.count(F.lit(1))).cast("int").alias("homepage_featured"),
        q.alias("num_orders"),
    )
    center = F.col("center_id").cast("bigint")
    # Unique by construction and ordered like (week, center, meal): no global numbering is needed.
    number = F.col("week").cast("bigint") * 10**13 + center * 1000 + F.col("meal_id")
    return weekly.select(
        number.alias("id"),
        "week",
        center.alias("center_id"),
        "meal_id",
        "checkout_price",
        "base_price",
        "emailer_for_promotion",
        "homepage_featured",
        "num_orders",
    )


def centers(spark: SparkSession, folder: str, grain: str = "supplier") -> DataFrame:
    if grain == "supplier":
        nations = read(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
        base = (
            read(spark, folder, "supplier")
            .select("s_suppkey", "s_nationkey")
            .join(nations, "s_nationkey")
            .select(
                F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("city"), F.col("n_regionkey").alias("zone")
            )
        )
    elif grain == "nation":
        base = read(spark, folder, "nation").select(
            F.col("n_nationkey").alias("key"), F.col("n_nationkey").alias("city"), F.col("n_regionkey").alias("zone")
        )
    else:
        base = read(spark, folder, "region").select(
            F.col("r_regionkey").alias("key"), F.col("r_regionkey").alias("city"), F.col("r_regionkey").alias("zone")
        )
    return base.select(
        F.col("key").cast("bigint").alias("center_id"),
        (500 + F.col("city")).cast("int").alias("city_code"),
        (30 + F.col("zone") % 3).cast("int").alias("region_code"),
        F.when(F.col("key") % 2 == 0, "TYPE_A").otherwise("TYPE_B").alias("center_type"),
        (2.5 + 0.5 * (F.col("key") % 25)).cast("double").alias("op_area"),
    )


def meals(spark: SparkSession, folder: str) -> DataFrame:
    number = meal_number(spark, folder)
    cuisine = F.element_at(F.array(*[F.lit(c) for c in CUISINES]), (F.col("meal_id") % 4 + 1).cast("int"))
    return (
        part_types(spark, folder)
        .select(number.alias("meal_id"), F.col("p_type").alias("category"))
        .withColumn("cuisine", cuisine)
    )


def star_tables(spark: SparkSession, folder: str, grain: str = "supplier") -> dict[str, DataFrame]:
    """The three mandatory input tables in the shape of their contracts."""
    return {
        "train": demand_panel(spark, folder, grain),
        "centers": centers(spark, folder, grain),
        "meals": meals(spark, folder),
    }
