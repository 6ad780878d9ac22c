"""Service level, safety stock and preparation expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import StockPolicy
from .numbers import at_least, col, half_up

# Standard normal quantile by service level.
Z_BY_LEVEL = {
    0.80: 0.8416,
    0.85: 1.0364,
    0.90: 1.2816,
    0.95: 1.6449,
    0.98: 2.0537,
    0.99: 2.3263,
}
LOWEST, HIGHEST, USUAL = 0.80, 0.99, 0.95


def z_score(level: float) -> float:
    """Quantile of a level known to the driver; a step function between the listed levels."""
    near = round(level, 2)
    if near in Z_BY_LEVEL:
        return Z_BY_LEVEL[near]
    if level >= HIGHEST:
        return Z_BY_LEVEL[HIGHEST]
    return Z_BY_LEVEL[LOWEST] if level <= LOWEST else Z_BY_LEVEL[USUAL]


def z_score_of(level: str | Column) -> Column:
    """The same rule for a level that is a column."""
    level = col(level)
    near = F.round(level.try_cast("decimal(38,10)"), 2)
    found = F.lit(None).cast("double")
    for known, z in Z_BY_LEVEL.items():
        found = F.when(near == F.lit(f"{known:.2f}").cast("decimal(10,2)"), z).otherwise(found)
    return F.coalesce(
        found,
        F.when(level >= HIGHEST, Z_BY_LEVEL[HIGHEST])
        .when(level <= LOWEST, Z_BY_LEVEL[LOWEST])
        .otherwise(Z_BY_LEVEL[USUAL]),
    )


def lead_factor(weeks: int) -> float:
    return math.sqrt(max(1, weeks))


def safety_stock(std: str | Column | float, policy: StockPolicy = StockPolicy()) -> Column:
    """max(floor, ceil(z * sqrt(lead) * std)); ``std`` may differ per row."""
    std = col(std) if isinstance(std, (str, Column)) else F.lit(float(std))
    buffer = F.ceil(F.lit(z_score(policy.service_level) * lead_factor(policy.lead_time_weeks)) * std)
    return at_least(buffer.cast("double"), float(policy.min_safety_stock))


def reorder_point(forecast: str | Column, stock: str | Column, policy: StockPolicy = StockPolicy()) -> Column:
    return col(forecast) * F.lit(policy.lead_time_weeks) + col(stock)


def preparation(forecast: str | Column, stock: str | Column, on_hand: Column | None = None) -> Column:
    on_hand = F.lit(0.0) if on_hand is None else on_hand
    return at_least(col(forecast) + col(stock) - on_hand, 0.0)


def recommendation(forecast, std, on_hand=None, policy: StockPolicy = StockPolicy()) -> list[Column]:
    """The columns of one recommendation, rounded to 2 digits."""
    stock = safety_stock(std, policy)
    return [
        half_up(forecast, 2).alias("forecast_demand"),
        half_up(stock, 2).alias("safety_stock"),
        half_up(preparation(forecast, stock, on_hand), 2).alias("recommended_preparation"),
        half_up(reorder_point(forecast, stock, policy), 2).alias("reorder_point"),
        F.lit(policy.service_level).alias("service_level"),
        F.lit(policy.lead_time_weeks).alias("lead_time_weeks"),
    ]
