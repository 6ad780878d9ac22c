"""A forecaster built from the profile numbers: price slope and promotion uplift per pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import at_least, clean
from ..sources.staging import stage
from .forecast import FORECAST, Forecaster
from .profiles import uplift


class ProfileForecaster(Forecaster):
    """expm1(intercept + slope * ln(price)) per pair, times the uplift on promoted rows.

    Reacts to price and promotion and needs no training loop, which makes the scenarios checkable in SQL.
    Rows without demand or price take no part in the fit. Unknown pairs get 0, known ones without a price null.
    """

    def __init__(self, keys: Sequence[str] = ("center_id", "meal_id"), target: str = "num_orders") -> None:
        self.keys, self.target = list(keys), target
        self.table: DataFrame | None = None

    def fit(self, df: DataFrame, validation: DataFrame | None = None) -> "ProfileForecaster":
        y = F.log1p(at_least(clean(self.target), 0.0))
        x = F.log(at_least(clean("checkout_price"), 1.0))
        fitted = (
            df.dropna(subset=self.keys)
            .groupBy(*self.keys)
            .agg(
                F.coalesce(F.regr_slope(y, x), F.lit(0.0)).alias("p_slope"),
                F.coalesce(F.regr_intercept(y, x), F.avg(y)).alias("p_start"),
                uplift(self.target).alias("p_uplift"),
            )
        )
        self.table = stage(fitted, "pair-slopes")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        price = F.log(at_least(clean("checkout_price"), 1.0))
        level = F.expm1(F.col("p_start") + F.col("p_slope") * price)
        lift = F.when(F.col("any_promo") == 1, F.col("p_uplift")).otherwise(1.0)
        kept = [c for c in df.columns if c != FORECAST]
        return df.join(self.table, self.keys, "left").select(
            *kept, F.when(F.col("p_start").isNull(), 0.0).otherwise(at_least(level * lift, 0.0)).alias(FORECAST)
        )
