"""Results on disk: feature table, plan, metrics and their way back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WEEKS_PER_BUCKET = 52
BUCKET = "week_bucket"


def write_features(df: DataFrame, folder: str) -> None:
    """Feature table, partitioned by blocks of weeks so that a time split reads only its part.

    Each task writes one file per block that it holds rows of. Blocks are few, and the tasks of a frame that comes out
    of a shuffle are large, so gathering the wide rows by block would be one more shuffle of the whole table for nothing.
    """
    bucketed = df.withColumn(BUCKET, F.floor((F.col("week") - 1) / WEEKS_PER_BUCKET).cast("int"))
    bucketed.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)


def read_features(spark: SparkSession, folder: str, first_week: int | None = None, last_week: int | None = None) -> DataFrame:
    """The feature table or a range of its weeks; blocks outside the range are not opened."""
    df = spark.read.parquet(folder)
    if first_week is not None:
        df = df.filter((F.col(BUCKET) >= (first_week - 1) // WEEKS_PER_BUCKET) & (F.col("week") >= first_week))
    if last_week is not None:
        df = df.filter((F.col(BUCKET) <= (last_week - 1) // WEEKS_PER_BUCKET) & (F.col("week") <= last_week))
    return df.drop(BUCKET)


def write_plan(plan: DataFrame, folder: str) -> None:
    plan.write.mode("overwrite").option("header", True).csv(folder)


def read_plan(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(folder)


def metrics_row(parts: dict[str, DataFrame], top_features: DataFrame | None = None) -> DataFrame:
    """One row with a struct per one-row frame and a feature-to-importance map."""
    spark = next(iter(parts.values())).sparkSession
    columns: list[Column] = [
        df.select(F.struct(*df.columns)).scalar().alias(name) for name, df in parts.items()
    ]
    if top_features is not None:
        # As many entries as were asked for.
        pairs = top_features.agg(F.map_from_entries(F.collect_list(F.struct("feature", "importance")))).scalar()
        columns.append(pairs.alias("top_features"))
    return spark.range(1).select(*columns)


def write_codes(mappings: dict[str, DataFrame], folder: str) -> None:
    """The category codes of all columns as one table (column, value, code), however many there are."""
    parts = [
        codes.select(F.lit(name).alias("column"), F.col("value").cast("string").alias("value"), "code")
        for name, codes in mappings.items()
    ]
    reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(folder)


def read_codes(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """What ``write_codes`` wrote, by column; the values are strings."""
    written = spark.read.schema("column string, value string, code int").parquet(folder)
    names = [r["column"] for r in written.select("column").distinct().collect()]  # one row per category column
    return {name: written.filter(F.col("column") == name).drop("column") for name in names}


def write_metrics(row: DataFrame, folder: str) -> None:
    row.coalesce(1).write.mode("overwrite").json(folder)


def read_metrics(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(folder)
