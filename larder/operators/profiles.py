"""Behaviour profile of every (center, meal) pair and the forecasts corrected by it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import at_least, clean, col, half_up
from .forecast import FORECAST
from .series import last_rows

KEYS = ("center_id", "meal_id")
DEFAULT_STD = 20.0
DEFAULT_Z = 1.6449
TRAILING = 10
# Defaults, guards and tier bounds of a profile.
NO_DEMAND, NO_UPLIFT, NO_ELASTICITY = 50.0, 1.25, -1.2
STD_FLOOR, STOCK_FLOOR, UNKNOWN_STOCK = 3.0, 5.0, 15.0
UPLIFT_RANGE, ELASTICITY_RANGE = (0.8, 3.5), (-4.0, 0.5)
VOLATILITY_BOUNDS, VOLUME_BOUNDS = (15.0, 35.0), (75.0, 250.0)


def _clip(c: Column, bounds: tuple[float, float]) -> Column:
    return F.least(F.greatest(c, F.lit(bounds[0])), F.lit(bounds[1]))


def _tier(c: str, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return F.when(F.col(c) > high, "HIGH").when(F.col(c) > low, "MEDIUM").otherwise("LOW")


def actual_column(df: DataFrame, actual: str) -> str:
    """``actual_orders`` wins over the named column when it is there."""
    return "actual_orders" if "actual_orders" in df.columns else actual


def uplift(actual: str) -> Column:
    promo, plain = F.col("any_promo") == 1, F.col("any_promo") == 0
    with_promo, without = F.avg(F.when(promo, F.col(actual))), F.avg(F.when(plain, F.col(actual)))
    enough = (F.count_if(promo) >= 2) & (F.count_if(plain) >= 2) & (without > 0)
    return F.coalesce(F.when(enough, _clip(with_promo / without, UPLIFT_RANGE)), F.lit(NO_UPLIFT))


def elasticity(actual: str, price: str = "checkout_price") -> Column:
    """Slope of log demand over log price, from the rows that have both."""
    both = clean(actual).isNotNull() & clean(price).isNotNull()
    demand, cost = F.when(both, clean(actual)), F.when(both, clean(price))
    log_demand, log_price = F.log1p(at_least(demand, 0.0)), F.log(at_least(cost, 1.0))
    enough = (F.count_if(both) >= 5) & (F.stddev_pop(cost) > 1e-3) & (F.stddev_pop(demand) > 1e-3)
    slope = F.when(enough, F.regr_slope(log_demand, log_price))
    return F.coalesce(F.when(slope.isNotNull() & ~F.isnan(slope), _clip(slope, ELASTICITY_RANGE)), F.lit(NO_ELASTICITY))


def deviation(c: Column) -> Column:
    """Population deviation that does not depend on the order of the rows where the sums are exact.

    Merged moments carry last-bit noise, which moves a pair across a tier's bound (15.000000000000002 > 15). Sums of
    whole and half numbers have none. Where the two differ by more than noise, the sums have lost digits.
    """
    n, total, squares = F.count(c), F.sum(c), F.sum(c * c)
    found, plain = F.stddev_pop(c), F.sqrt(n * squares - total * total) / n
    return F.when(F.abs(plain - found) <= 1e-9 * found, plain).otherwise(found)


def profile_numbers(
    df: DataFrame,
    forecast: str = FORECAST,
    actual: str = "num_orders",
    keys: Sequence[str] = KEYS,
    default_std: float = DEFAULT_STD,
    z: float = DEFAULT_Z,
) -> DataFrame:
    """Unrounded profile numbers, one row per pair.

    Everything but the trailing bias is an aggregate that combines on the map side. The bias needs the
    last rows of each pair; those are limited per task before they are shuffled. So a pair with a very
    long history costs no more than any other.
    """
    keys = list(keys)
    actual = actual_column(df, actual)
    has_actual, has_forecast = actual in df.columns, forecast in df.columns
    df = df.dropna(subset=keys)
    n = F.count(F.lit(1))
    out: list[Column] = [n.alias("n")]
    out.append((F.avg(actual) if has_actual else F.lit(NO_DEMAND)).alias("demand"))
    residual = (col(actual) - col(forecast)) if has_actual and has_forecast else None
    if residual is not None:
        spread = F.when(n >= 3, F.greatest(F.lit(STD_FLOOR), deviation(residual)))
        out.append(F.coalesce(spread, F.lit(float(default_std))).alias("std"))
    else:
        out.append(F.lit(float(default_std)).alias("std"))
    has_promo = has_actual and "any_promo" in df.columns
    out.append((uplift(actual) if has_promo else F.lit(NO_UPLIFT)).alias("uplift"))
    has_price = has_actual and "checkout_price" in df.columns
    out.append((elasticity(actual) if has_price else F.lit(NO_ELASTICITY)).alias("elasticity"))
    profile = df.groupBy(*keys).agg(*out)

    if residual is not None:
        order = [c for c in ("week", "id") if c in df.columns]
        if not order:
            raise ValueError("the trailing bias needs a 'week' or 'id' column to order by")
        trailing = last_rows(df.select(*keys, *order, residual.alias("residual")), keys, order, TRAILING)
        bias = trailing.groupBy(*keys).agg(F.avg("residual").alias("trailing_bias"))
        profile = profile.join(bias, keys, "left").withColumn(
            "bias", F.when(F.col("n") >= 3, F.coalesce("trailing_bias", F.lit(0.0))).otherwise(0.0)
        )
    else:
        profile = profile.withColumn("bias", F.lit(0.0))
    return profile.select(
        *keys,
        "n",
        "demand",
        "elasticity",
        "uplift",
        "bias",
        "std",
        F.greatest(F.lit(STOCK_FLOOR), F.ceil(F.lit(z) * F.col("std")).cast("double")).alias("stock"),
    )


def sku_profiles(
    df: DataFrame,
    forecast: str = FORECAST,
    actual: str = "num_orders",
    default_std: float = DEFAULT_STD,
    z: float = DEFAULT_Z,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """The profile table; rounding happens here only."""
    numbers = profile_numbers(df, forecast, actual, keys, default_std, z)
    return numbers.select(
        *keys,
        half_up("demand", 1).alias("average_weekly_demand"),
        half_up("elasticity", 2).alias("price_elasticity_estimate"),
        half_up("uplift", 2).alias("promo_uplift_ratio"),
        half_up("bias", 2).alias("recent_residual_bias"),
        half_up("std", 2).alias("residual_std"),
        half_up("stock", 1).alias("recommended_safety_stock"),
        _tier("std", VOLATILITY_BOUNDS).alias("volatility_tier"),
        _tier("demand", VOLUME_BOUNDS).alias("volume_tier"),
    )


def profiles_head(profiles: DataFrame, n: int = 10) -> DataFrame:
    return profiles.orderBy(*KEYS).limit(n)


def adaptive_forecast(
    df: DataFrame,
    profiles: DataFrame,
    rate: float = 0.65,
    forecast: str = FORECAST,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Add ``adaptive_orders`` and ``adaptive_stock``: bias-corrected where the pair has a profile.

    A missing forecast stays missing.
    """
    found = profiles.select(
        *keys, F.col("recent_residual_bias").alias("p_bias"), F.col("recommended_safety_stock").alias("p_stock")
    )
    known = F.col("p_stock").isNotNull()
    corrected = at_least(clean(col(forecast)) + F.lit(rate) * F.col("p_bias"), 0.0)
    return df.join(found, list(keys), "left").select(
        *df.columns,
        F.when(known, corrected).otherwise(col(forecast)).alias("adaptive_orders"),
        F.when(known, F.col("p_stock")).otherwise(F.lit(UNKNOWN_STOCK)).alias("adaptive_stock"),
    )
