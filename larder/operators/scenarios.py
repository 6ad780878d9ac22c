"""What-if scenarios: rescore a frame under changed prices and promotions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import half_up
from .forecast import FORECAST, Forecaster
from .inventory import DEFAULT_STD, stock_plan

BASE = "base"


@dataclass(frozen=True)
class Scenario:
    key: str
    name: str
    description: str
    expected: str


# Names and expected directions of the scenarios.
SCENARIOS = (
    Scenario("price_surge", "Price Surge (+30%)", "Every price goes up by three tenths.", "DOWN"),
    Scenario(
        "flash_sale", "Flash Sale (-35% Price)", "Every price goes down by 35 in a hundred.", "UP"
    ),
    Scenario(
        "promo_blitz",
        "Promotional Blitz (Email + Homepage)",
        "Every meal is promoted by e-mail and on the homepage.",
        "UP",
    ),
    Scenario(
        "blackout", "Promotion Blackout", "No meal is promoted at all.", "DOWN"
    ),
)
PASSED = "PASSED: Model behaves consistently with economic and operational dynamics."
CAUTION = "CAUTION: Some scenario responses violated theoretical directions."
TOLERANCE = 5.0
SURGE, SALE, SALE_DEPTH, DEPTH_CAP = 1.30, 0.65, 0.35, 0.9

_FLAGS = ("emailer_for_promotion", "homepage_featured", "both_promos", "any_promo")


def changes(key: str, columns: list[str]) -> dict[str, Column]:
    """The columns a scenario changes; nothing that depends on them is recomputed."""
    if key == "price_surge" and "checkout_price" in columns:
        return {c: F.col(c) * F.lit(SURGE) for c in ("checkout_price", "price_ratio") if c in columns}
    if key == "flash_sale" and "checkout_price" in columns:
        deeper = F.least(F.greatest(F.col("discount_ratio") + F.lit(SALE_DEPTH), F.lit(0.0)), F.lit(DEPTH_CAP))
        new = {"checkout_price": F.col("checkout_price") * F.lit(SALE)}
        if "discount_ratio" in columns:
            new["discount_ratio"] = F.when(F.col("discount_ratio").isNotNull(), deeper)
        return new
    if key == "promo_blitz":
        return {c: F.lit(1) for c in _FLAGS if c in columns}
    if key == "blackout":
        return {c: F.lit(0) for c in (*_FLAGS, "promo_discount_synergy") if c in columns}
    return {}


def apply_scenario(df: DataFrame, key: str) -> DataFrame:
    new = changes(key, df.columns)
    return df.select(*[new[c].cast(df.schema[c].dataType).alias(c) if c in new else F.col(c) for c in df.columns])


def all_scenarios(df: DataFrame, with_base: bool = True) -> DataFrame:
    """Every row under every scenario, labelled ``scenario``; rows are multiplied without a join."""
    keys = ([BASE] if with_base else []) + [s.key for s in SCENARIOS]
    label = F.col("scenario")
    rows = df.withColumn("scenario", F.explode(F.array(*[F.lit(k) for k in keys])))
    updated: dict[str, Column] = {}
    for s in SCENARIOS:
        for c, new in changes(s.key, df.columns).items():
            updated[c] = F.when(label == s.key, new.cast(df.schema[c].dataType)).otherwise(updated.get(c, F.col(c)))
    return rows.select("scenario", *[updated.get(c, F.col(c)).alias(c) for c in df.columns])


def scenario_totals(scored: DataFrame) -> DataFrame:
    """Totals per scenario of a scored frame: demand, preparation and buffer of the default plan."""
    plan = stock_plan(scored, std=DEFAULT_STD)
    return plan.groupBy("scenario").agg(
        F.sum(FORECAST).alias("total"),
        F.sum("recommended_preparation").alias("prep"),
        F.sum("safety_stock").alias("buffer"),
    )


def scenario_outcomes(totals: DataFrame) -> DataFrame:
    """One row per scenario with the change against the base and whether its direction makes sense."""
    facts = F.create_map(
        *[
            x
            for i, s in enumerate(SCENARIOS)
            for x in (
                F.lit(s.key),
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(s.name).alias("name"),
                    F.lit(s.description).alias("description"),
                    F.lit(s.expected).alias("expected"),
                ),
            )
        ]
    )
    # Five rows at this point: one per scenario and the base.
    base = F.max(F.when(F.col("scenario") == BASE, F.col("total"))).over(Window.partitionBy())
    rows = totals.withColumn("base", base).filter(F.col("scenario") != BASE).withColumn("s", facts[F.col("scenario")])
    change = (F.col("total") - F.col("base")) / F.greatest(F.lit(1.0), F.col("base")) * 100
    wrong = ((F.col("s.expected") == "DOWN") & (change > TOLERANCE)) | (
        (F.col("s.expected") == "UP") & (change < -TOLERANCE)
    )
    return rows.select(
        F.col("s.position").alias("position"),
        F.col("s.name").alias("scenario_name"),
        F.col("s.description").alias("description"),
        half_up("base", 1).alias("baseline_total_demand"),
        half_up("total", 1).alias("stressed_total_demand"),
        half_up(change, 2).alias("percentage_change"),
        half_up("prep", 1).alias("recommended_prep_units"),
        half_up("buffer", 1).alias("buffer_overhead_units"),
        (~wrong).alias("direction_valid"),
    )


def stress_verdict(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(F.when(F.bool_and("direction_valid"), PASSED).otherwise(CAUTION).alias("summary_verdict"))


def stress_test(df: DataFrame, forecaster: Forecaster) -> DataFrame:
    """Base and scenarios scored in one pass."""
    return scenario_outcomes(scenario_totals(forecaster.transform(all_scenarios(df))))
