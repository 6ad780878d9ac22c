"""Approximate quantiles that are kept and merged: one small sketch for each group and block of weeks.

The exact quantiles of ``heavy`` read all rows again for every question. Here the rows of a block of weeks are read
once, when the block arrives; medians or bin edges of any range of whole blocks are merged from the sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import clean

SIZE = 200  # the parameter k of a sketch: its size, some 2.7 kB at most, and its error
RANK_ERROR = 0.0133  # for that size: the rank of a found quantile is this far off or less, with 99 % probability
BLOCK_WEEKS = 13


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, week: str = "week", block_weeks: int = BLOCK_WEEKS) -> DataFrame:
    """``keys, block, sketch`` over the values of each group in each block of weeks; missing values, keys and weeks are left out.

    Sketches merge on the map side: of a hot group each task sends one sketch.
    """
    block = F.floor((F.col(week) - 1) / block_weeks).cast("int").alias("block")
    rows = df.select(*keys, block, clean(value).alias("_value")).dropna()
    return rows.groupBy(*keys, "block").agg(F.kll_sketch_agg_double("_value", F.lit(SIZE)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """``keys, n, quantiles``: of all sketched values of each group, each within ``RANK_ERROR`` of its rank."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(SIZE)).alias("_sketch"))
    found = [F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))) for p in probabilities]
    return merged.select(*keys, F.kll_sketch_get_n_double("_sketch").alias("n"), F.array(*found).alias("quantiles"))


class SketchTable:
    """Sketches in a Parquet table with one folder for each block of weeks.

    Adding a block again replaces its folder, so that a repeated load counts once; other blocks are not read.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], value: str, week: str = "week", block_weeks: int = BLOCK_WEEKS):
        self.spark, self.folder, self.keys, self.value = spark, folder, list(keys), value
        self.week, self.block_weeks = week, block_weeks

    def add(self, df: DataFrame) -> None:
        """Sketches the rows of whole blocks of weeks."""
        made = quantile_sketches(df, self.keys, self.value, self.week, self.block_weeks)
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("block").parquet(self.folder)

    def quantiles(self, probabilities: Sequence[float], first_block: int | None = None, last_block: int | None = None) -> DataFrame:
        """Merged over the blocks from ``first_block`` to ``last_block``; only their folders are opened."""
        held = self.spark.read.parquet(self.folder)
        if first_block is not None:
            held = held.filter(F.col("block") >= first_block)
        if last_block is not None:
            held = held.filter(F.col("block") <= last_block)
        return merged_quantiles(held, self.keys, probabilities)

    def medians(self, **blocks) -> DataFrame:
        """``keys, group_median``, in the form that ``forecast.apply_medians`` takes."""
        return self.quantiles([0.5], **blocks).select(*self.keys, F.col("quantiles")[0].alias("group_median"))
