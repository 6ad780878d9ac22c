"""Forecasters and their evaluation.

A forecaster is fitted on a frame and then adds a ``forecast_orders`` column to another one. Users may
pass any class of that shape, and a zero-argument factory of it wherever fresh models are needed.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scores
from ..functions.numbers import at_least, clean
from ..sources.staging import stage
from .heavy import SPREAD, _all_set, _between, exact_quantiles, group_median, value_counts

FORECAST = "forecast_orders"


class Forecaster(ABC):
    target: str = "num_orders"

    @abstractmethod
    def fit(self, df: DataFrame, validation: DataFrame | None = None) -> "Forecaster": ...

    @abstractmethod
    def transform(self, df: DataFrame) -> DataFrame: ...

    def evaluate(self, df: DataFrame) -> DataFrame:
        """Score the frame and return the four measures as one row."""
        return score(self.transform(df), self.target)


def score(
    df: DataFrame, actual: str | Column = "num_orders", forecast: str | Column = FORECAST, by: Sequence[str] = ()
) -> DataFrame:
    """mae, rmse, wmape and rmsle of a frame or, with ``by``, of each group of it."""
    sums = df.groupBy(*by).agg(*scores.error_sums(actual, forecast)) if by else df.agg(
        *scores.error_sums(actual, forecast)
    )
    return sums.select(*by, *[c.alias(name) for name, c in scores.from_sums().items()])


def median_table(df: DataFrame, keys: Sequence[str], target: str, **limits) -> DataFrame:
    """(keys, group_median): exact median of the target per group; null keys are left out."""
    return group_median(df, keys, target, "group_median", **limits)


def overall_median(df: DataFrame, target: str, **limits) -> DataFrame:
    """One row with the median of the target, 0 for an empty frame."""
    return group_median(df, [], target, "overall_median", **limits).agg(
        F.coalesce(F.max("overall_median"), F.lit(0.0)).alias("overall_median")
    )


def _some_value(kind: T.DataType) -> Column:
    """Any non-null value of a key type."""
    text = {T.StringType: "", T.BooleanType: "false", T.DateType: "1970-01-01"}.get(type(kind))
    if text is None:
        text = "0" if isinstance(kind, T.NumericType) else "1970-01-01 00:00:00"
    return F.lit(text).cast(kind)


def target_counts(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """(keys, value, weight): how often each target value occurs, written; a missing target is a null value."""
    value = clean(target).alias("value")
    counts = df.select(*keys, value).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("weight"))
    return stage(counts, "value-counts")


def count_medians(counts: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(level, by, keys, median) of ``target_counts`` rows, in which a value may stand several times.

    Level 1 has the median per (by, keys), level 0 the one per ``by``: the counts add up to those of the whole,
    which is then ordered like one more group. At level 0 the keys have no meaning.
    """
    by, keys = list(by), list(keys)
    counts = counts.filter("value IS NOT NULL")
    whole = counts.groupBy(*by, "value").agg(F.sum("weight").alias("weight"))
    unused = [_some_value(counts.schema[k].dataType).alias(k) for k in keys]
    both = whole.select(F.lit(0).alias("level"), *by, *unused, "value", "weight")
    if keys:
        groups = counts.dropna(subset=keys)
        both = both.unionByName(groups.select(F.lit(1).alias("level"), *by, *keys, "value", "weight"))
    found = exact_quantiles(both, ["level", *by, *keys], [0.5])
    return stage(found.select("level", *by, *keys, F.col("quantiles")[0].alias("median")), "medians")


def median_levels(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """(level, keys, median) of the target per group and of all rows; the frame is read once."""
    return count_medians(target_counts(df, keys, target), keys)


def series_values(df: DataFrame, keys: Sequence[str], target: str, week: str = "week") -> DataFrame:
    """(keys, values): the target of each series in increasing order, written; missing targets are left out.

    For frames with one row per series and week, so that a list is never longer than the calendar. Rows without a full
    key are no series; they are kept in lists dealt over the tasks.
    """
    rows = df.select(*keys, week, clean(target).alias("value")).filter("value IS NOT NULL")
    apart = F.when(_all_set(keys), 0).otherwise(F.pmod(F.xxhash64(week, "value"), F.lit(SPREAD))).alias("apart")
    lists = rows.groupBy(*keys, apart).agg(F.sort_array(F.collect_list("value")).alias("values"))
    return stage(lists.drop("apart"), "series-values")


def series_medians(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, group_median) of ``series_values`` rows, written; nothing is shuffled."""
    place = (F.size("values") - 1) * F.lit(0.5)
    low, high = F.get("values", F.floor(place).cast("int")), F.get("values", F.ceil(place).cast("int"))
    median = _between(low, high, place - F.floor(place))
    return stage(values.dropna(subset=list(keys)).select(*keys, median.alias("group_median")), "medians")


def apply_medians(df: DataFrame, medians: DataFrame, overall: Column, keys: Sequence[str]) -> DataFrame:
    """Group median where the group is known, else the overall median, clipped at 0."""
    known = df.join(medians, list(keys), "left")
    forecast = at_least(F.coalesce("group_median", overall), 0.0)
    return known.select(*[c for c in df.columns if c != FORECAST], forecast.alias(FORECAST))


class MedianForecaster(Forecaster):
    """Baseline: the historical median of each group.

    ``one_row_per_week`` tells that a group has one row for a week of the calendar (as after a group-by on the week). Its
    values are then gathered in one shuffle and need not be counted first.
    """

    def __init__(
        self,
        keys: Sequence[str] = ("center_id", "meal_id"),
        target: str = "num_orders",
        one_row_per_week: bool = False,
        week: str = "week",
    ) -> None:
        self.keys, self.target = list(keys), target
        self.one_row_per_week, self.week = one_row_per_week, week
        self.medians: DataFrame | None = None
        self.overall: float = 0.0

    def fit(self, df: DataFrame, validation: DataFrame | None = None) -> "MedianForecaster":
        keys = self.keys if set(self.keys) <= set(df.columns) else []
        if keys and self.one_row_per_week:
            values = series_values(df, keys, self.target, self.week)
            self.medians = series_medians(values, keys)
            each = values.select(F.explode("values").alias("value"))
            whole = exact_quantiles(stage(value_counts(each, [], "value"), "value-counts"), [], [0.5]).first()
            self.overall = whole.quantiles[0] if whole else 0.0
            return self
        levels = median_levels(df, keys, self.target)
        whole = levels.filter("level = 0").first()
        self.overall = whole.median if whole else 0.0
        groups = levels.filter("level = 1").select(*keys, F.col("median").alias("group_median"))
        self.medians = groups if keys else None
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.medians is None:
            return df.withColumn(FORECAST, F.lit(max(0.0, self.overall)))
        return apply_medians(df, self.medians, F.lit(self.overall), self.keys)


def compare(frames: dict[str, DataFrame], baseline: str, actual: str = "num_orders") -> DataFrame:
    """Measures per model side by side, with the WMAPE gain over the baseline in percent."""
    scored = [score(df, actual).withColumn("model", F.lit(name)) for name, df in frames.items()]
    # One row per model, written because the baseline's row is read again for the gain.
    rows = stage(reduce(DataFrame.unionByName, scored), "model-scores")
    reference = rows.filter(F.col("model") == baseline).select("wmape").scalar()
    gain = F.when(reference > 0, (reference - F.col("wmape")) / reference * 100).otherwise(0.0)
    return rows.select("model", "mae", "rmse", "wmape", "rmsle", F.round(gain, 2).alias("gain_pct"))
