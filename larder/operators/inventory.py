"""Preparation plan, its totals, and the cost replay of service-level policies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import StockPolicy
from ..functions import scores
from ..functions.numbers import at_least, clean, col, half_up
from ..functions.stock import Z_BY_LEVEL, preparation, recommendation, reorder_point, safety_stock, z_score
from .forecast import FORECAST

DEFAULT_STD = 20.0
LEVELS = tuple(Z_BY_LEVEL)


def residual_rmse(df: DataFrame, actual: str = "num_orders", forecast: str = FORECAST) -> DataFrame:
    """One row ``residual_rmse``; use ``.scalar()`` of it as the deviation of the plan."""
    return df.agg(scores.plain_rmse(actual, forecast).alias("residual_rmse"))


def recommend(
    df: DataFrame,
    forecast: str = FORECAST,
    std: str | Column | float = DEFAULT_STD,
    on_hand: str | None = None,
    policy: StockPolicy = StockPolicy(),
) -> DataFrame:
    """One recommendation per row; every argument may be a column."""
    stock = F.coalesce(col(on_hand), F.lit(0.0)) if on_hand else F.lit(0.0)
    return df.select("*", *[c for c in recommendation(forecast, std, stock, policy)])


def stock_plan(
    df: DataFrame,
    forecast: str = FORECAST,
    std: str | Column | float = DEFAULT_STD,
    on_hand: str | None = None,
    policy: StockPolicy = StockPolicy(),
) -> DataFrame:
    """Add safety stock, reorder point and recommended preparation (1 digit) for one common deviation."""
    if forecast not in df.columns:
        raise KeyError(f"forecast column '{forecast}' is not in the frame")
    held = col(on_hand) if on_hand and on_hand in df.columns else None
    return (
        df.withColumn("safety_stock", safety_stock(std, policy))
        .withColumn("reorder_point", reorder_point(forecast, "safety_stock", policy))
        .withColumn("recommended_preparation", half_up(preparation(forecast, "safety_stock", held), 1))
    )


def plan_totals(df: DataFrame, forecast: str = FORECAST) -> DataFrame:
    """Totals of a plan in one row; zeros for an empty plan."""
    total, prep, stock = (F.coalesce(F.sum(c), F.lit(0.0)) for c in (forecast, "recommended_preparation", "safety_stock"))
    sums = df.agg(total.alias("f"), prep.alias("p"), stock.alias("s"))
    share = F.when(F.col("f") > 0, F.col("s") / F.greatest("f", F.lit(1.0)) * 100).otherwise(0.0)
    return sums.select(
        half_up("f", 1).alias("total_forecasted_units"),
        half_up("p", 1).alias("total_recommended_preparation_units"),
        half_up("s", 1).alias("total_safety_stock_buffer_units"),
        half_up(share, 2).alias("buffer_overhead_percentage"),
    )


PLAN_COLUMNS = (
    "week",
    "center_id",
    "meal_id",
    "forecast_orders",
    "safety_stock",
    "reorder_point",
    "recommended_preparation",
)


def plan_head(plan: DataFrame, n: int = 20) -> DataFrame:
    return plan.select(*PLAN_COLUMNS).orderBy("week", "center_id", "meal_id").limit(n)


# The costs that a replay assumes.
@dataclass(frozen=True)
class ReplayCosts:
    unit_price: float = 120.0
    holding_per_unit_week: float = 5.0
    stockout_penalty: float = 40.0
    spoilage_rate: float = 0.30


REPLAY_STD = 25.0


def replay_buffer(level: float, std: float) -> float:
    import math

    return max(5.0, math.ceil(z_score(level) * std))


def policy_rows(
    df: DataFrame,
    levels: Sequence[float] = LEVELS,
    std: float = REPLAY_STD,
    forecast: str = FORECAST,
    costs: ReplayCosts = ReplayCosts(),
    actual: str = "actual_orders",
) -> DataFrame:
    """Every row under every policy: prepared, fulfilled, missing and wasted units.

    Without a demand or a forecast the units that depend on it are null.
    """
    policies = F.array(
        *[
            F.struct(F.lit(float(v)).alias("service_level"), F.lit(replay_buffer(v, std)).alias("buffer"))
            for v in levels
        ]
    )
    prepared = col(forecast) + F.col("buffer")
    return (
        df.select("*", F.inline(policies))
        .withColumn("prepared", prepared)
        .withColumn("fulfilled", F.when(col(actual).isNotNull() & F.col("prepared").isNotNull(), F.least(col(actual), F.col("prepared"))))
        .withColumn("stockout", at_least(col(actual) - F.col("prepared"), 0.0))
        .withColumn("wasted", at_least(F.col("prepared") - col(actual), 0.0) * F.lit(costs.spoilage_rate))
    )


def policy_replay(
    df: DataFrame,
    forecast: str = FORECAST,
    actual: str = "actual_orders",
    std: float = REPLAY_STD,
    levels: Sequence[float] = LEVELS,
    costs: ReplayCosts = ReplayCosts(),
) -> DataFrame:
    """Cost of each policy had it been in force; one row per service level.

    All policies are summed side by side in one aggregation and turned into rows afterwards, so the
    input is neither multiplied nor shuffled. Rows without a demand or a forecast (null or NaN) cannot be
    replayed; they are left out of all sums and counted as ``unscored_rows``.
    """
    both = clean(forecast).isNotNull() & clean(actual).isNotNull()
    f, a = F.when(both, clean(forecast)), F.when(both, clean(actual))
    sums: list[Column] = [F.count_if(both).alias("n"), F.count_if(~both).alias("unscored_rows"), F.sum(a).alias("demand")]
    for i, level in enumerate(levels):
        prepared = f + F.lit(replay_buffer(level, std))
        sums += [
            F.sum(prepared).alias(f"prepared{i}"),
            F.sum(F.when(both, F.least(a, prepared))).alias(f"fulfilled{i}"),
            F.sum(at_least(a - prepared, 0.0)).alias(f"stockout{i}"),
            F.sum(at_least(prepared - a, 0.0)).alias(f"unneeded{i}"),
            F.count_if(a > prepared).alias(f"events{i}"),
        ]
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(float(level)).alias("service_level"),
            F.lit(z_score(level)).alias("z"),
            F.col("n"),
            F.col("unscored_rows"),
            F.col("demand"),
            *[F.col(f"{c}{i}").alias(c) for c in ("prepared", "fulfilled", "stockout", "unneeded", "events")],
        )
        for i, level in enumerate(levels)
    ]
    each = df.agg(*sums).filter("n > 0").select(F.inline(F.array(*rows)))
    # The share comes after the sum and in decimals: sums of whole and half units are exact in any order of the rows.
    share = F.lit(str(costs.spoilage_rate)).cast("decimal(10,6)")
    each = each.withColumn("wasted", (F.col("unneeded").try_cast("decimal(26,6)") * share).cast("double"))
    each = each.withColumn("holding", F.col("wasted") * F.lit(costs.holding_per_unit_week)).withColumn(
        "loss", F.col("stockout") * F.lit(costs.unit_price + costs.stockout_penalty)
    )
    fill = F.when(F.col("demand") > 0, F.col("fulfilled") / F.greatest(F.lit(1.0), F.col("demand")) * 100)
    return each.select(
        "position",
        "service_level",
        half_up("z", 3).alias("z_score"),
        "unscored_rows",
        half_up("demand", 1).alias("total_demand_units"),
        half_up("prepared", 1).alias("total_prepared_units"),
        half_up("fulfilled", 1).alias("total_fulfilled_units"),
        half_up("stockout", 1).alias("total_stockout_units"),
        half_up("wasted", 1).alias("total_wasted_units"),
        half_up(F.col("events") / F.col("n") * 100, 2).alias("stockout_event_rate"),
        half_up(fill.otherwise(100.0), 2).alias("fill_rate_percentage"),
        half_up("holding", 2).alias("estimated_holding_cost"),
        half_up("loss", 2).alias("estimated_stockout_loss"),
        half_up(F.col("holding") + F.col("loss"), 2).alias("total_operational_cost"),
        (F.col("holding") + F.col("loss")).alias("exact_cost"),
    )


def replay_report(replay: DataFrame) -> DataFrame:
    return replay.drop("position", "exact_cost")


def best_policy(replay: DataFrame) -> DataFrame:
    """The cheapest level on unrounded cost; the first one on a tie; 0.95 when there was no data."""
    cheapest = F.min_by("service_level", F.struct("exact_cost", "position"))
    return replay.agg(F.coalesce(cheapest, F.lit(0.95)).alias("optimal_service_level"))


def replay_timeline(
    df: DataFrame, forecast: str = FORECAST, actual: str = "actual_orders", std: float = REPLAY_STD
) -> DataFrame:
    return df.select(*[c for c in ("week", "center_id", "meal_id") if c in df.columns], forecast, actual).withColumn(
        "recommended_95", col(forecast) + F.lit(replay_buffer(0.95, std))
    )
