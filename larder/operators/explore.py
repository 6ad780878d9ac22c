"""Summaries for looking at a demand panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import col


def weekly_totals(plan: DataFrame, columns=("actual_orders", "forecast_orders", "recommended_preparation")) -> DataFrame:
    return plan.groupBy("week").agg(*[F.sum(c).alias(c) for c in columns])


def weekly_demand(panel: DataFrame, target: str = "num_orders") -> DataFrame:
    return panel.groupBy("week").agg(F.sum(target).alias(target))


def promo_means(panel: DataFrame, target: str = "num_orders") -> DataFrame:
    return panel.groupBy("emailer_for_promotion", "homepage_featured").agg(F.avg(target).alias("mean_orders"))


def histogram(df: DataFrame, value: str | Column, bins: int = 40) -> DataFrame:
    """(bin, low, high, rows) of equal-width bins; the last bin is closed. Empty bins are listed too."""
    values = df.select(col(value).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    bounds = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    low, high = bounds["low"], bounds["high"]
    width = (high - low) / F.lit(bins)
    place = F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col("v") - low) / F.nullif(width, F.lit(0.0)))))
    counts = values.groupBy(F.coalesce(place, F.lit(0)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("rows"),
    )


def corrected_skewness(value: str | Column) -> Column:
    """Skewness with the small-sample correction; needs at least 3 values, 0 for a constant."""
    value = col(value)
    n = F.count(value).cast("double")
    factor = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n >= 3, F.when(F.var_pop(value) == 0, 0.0).otherwise(F.skewness(value) * factor))


def demand_skewness(df: DataFrame, value: str = "num_orders") -> DataFrame:
    return df.agg(
        corrected_skewness(value).alias("raw_skewness"),
        corrected_skewness(F.log1p(F.col(value))).alias("log_skewness"),
    )


def last_history(log: DataFrame, max_history: int = 100_000) -> DataFrame:
    """The newest records; (batch, week, center, meal) orders the arrivals."""
    if max_history <= 0:
        raise ValueError(f"max_history must be positive, got {max_history}")
    order = [F.col(c).desc() for c in ("batch_id", "week", "center_id", "meal_id") if c in log.columns]
    return log.orderBy(*order).limit(max_history)
