"""Splits by time and small selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import WeekSplit
from .heavy import group_median


def _check(df: DataFrame, time: str, split: WeekSplit) -> None:
    if time not in df.columns:
        raise KeyError(f"time column '{time}' is not in the frame")
    if split.train_end >= split.val_end:
        raise ValueError(f"train_end ({split.train_end}) must be below val_end ({split.val_end})")


def split_label(time: str = "week", split: WeekSplit = WeekSplit()) -> Column:
    t = F.col(time)
    return (
        F.when(t <= split.train_end, "train")
        .when(t <= split.val_end, "validation")
        .when(t > split.val_end, "test")
    )


def with_split(df: DataFrame, time: str = "week", split: WeekSplit = WeekSplit()) -> DataFrame:
    """Label instead of three copies; a filter on the label reads one scan."""
    _check(df, time, split)
    return df.withColumn("split", split_label(time, split))


def time_split(
    df: DataFrame, time: str = "week", split: WeekSplit = WeekSplit()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test as three filters, which reach the scan."""
    _check(df, time, split)
    t = F.col(time)
    return (
        df.filter(t <= split.train_end),
        df.filter((t > split.train_end) & (t <= split.val_end)),
        df.filter(t > split.val_end),
    )


def week_range(df: DataFrame, first: int, last: int, time: str = "week") -> DataFrame:
    return df.filter(F.col(time).between(first, last))


def half_split(df: DataFrame, time: str = "week") -> DataFrame:
    """Label ``side``: weeks up to the median row's week are ``baseline``, later ones ``current``."""
    middle = group_median(df, [], time, "middle").scalar()
    return df.withColumn("side", F.when(F.col(time) <= middle, "baseline").otherwise("current"))


def equal_to(df: DataFrame, **wanted) -> DataFrame:
    """Keep rows equal to each given value; ``None`` means no restriction."""
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def fixed_sample(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """Up to n rows, the same ones each time: the n smallest MD5 hashes of the key and the seed."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) of several integer columns, sorted; the values are combined per task first."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).filter("value IS NOT NULL").distinct().orderBy("column", "value")
