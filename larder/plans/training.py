"""From input tables to forecasts, plan and written results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..operators.boosted import BoostedForecaster
from ..operators.features import feature_frame
from ..operators.forecast import FORECAST, Forecaster, MedianForecaster, score
from ..operators.inventory import plan_totals, residual_rmse, stock_plan
from ..operators.split import time_split
from ..session import fresh_folder, remove, short_shuffles
from ..sources import artifacts
from ..sources.staging import stage


@dataclass(frozen=True)
class TrainingResult:
    baseline_metrics: DataFrame
    model_metrics: DataFrame
    totals: DataFrame
    plan: DataFrame
    top_features: DataFrame | None
    forecaster: Forecaster
    features: list[str]
    mappings: dict[str, DataFrame]
    train_rows: int
    test_rows: int


def plan_for(scored: DataFrame, validation_scored: DataFrame, settings: Settings, target: str) -> DataFrame:
    """The plan of a scored frame, its buffer based on the validation residuals."""
    std = residual_rmse(validation_scored, target).scalar()
    actual = scored.withColumn("actual_orders", F.col(target).cast("double"))
    return stock_plan(actual, FORECAST, std, policy=settings.stock)


def train(
    tables: dict[str, DataFrame],
    settings: Settings = DEFAULTS,
    forecaster: Forecaster | None = None,
    folder: str | None = None,
    one_row_per_week: bool = False,
) -> TrainingResult:
    """Features, baseline, model, plan and totals; everything is written when a folder is given.

    The features are written once and read back by every later step, so none of them repeats the joins
    and windows, and the splits open only their weeks. The panel itself and the shuffles are removed as soon as
    nothing reads them any more.
    """
    with short_shuffles(tables["train"].sparkSession):
        return _train(tables, settings, forecaster, folder, one_row_per_week)


def _train(
    tables: dict[str, DataFrame], settings: Settings, forecaster: Forecaster | None, folder: str | None, one_row_per_week: bool
) -> TrainingResult:
    target = settings.features.target
    spark = tables["train"].sparkSession
    fact = fresh_folder(spark, "train")
    source = stage(tables["train"], folder=fact)
    metadata = (stage(tables["centers"], "centers"), stage(tables["meals"], "meals"))
    frame, features, mappings = feature_frame(
        source, settings.features, one_row_per_week=one_row_per_week, metadata=metadata
    )
    place = f"{folder}/data/processed/merged_features" if folder else fresh_folder(spark, "features")
    split = settings.split
    time_split(frame, split=split)  # raises on a wrong split
    artifacts.write_features(frame, place)
    remove(spark, fact)
    train_part = artifacts.read_features(spark, place, last_week=split.train_end)
    validation = artifacts.read_features(spark, place, split.train_end + 1, split.val_end)
    test = artifacts.read_features(spark, place, split.val_end + 1)

    baseline = MedianForecaster(settings.features.keys, target)
    model = forecaster or BoostedForecaster(features, settings.boost, target, settings.features.log_target)
    model.fit(train_part, validation)
    # The plan holds the scored test weeks; of the validation weeks only the residuals are used.
    checked = stage(model.transform(validation).select(target, FORECAST), "val-scored")
    plan = stage(plan_for(model.transform(test), checked, settings, target), "plan")
    metrics = score(plan, target)
    same = type(model) is MedianForecaster and (model.keys, model.target) == (baseline.keys, baseline.target)
    result = TrainingResult(
        baseline_metrics=metrics if same else baseline.fit(train_part).evaluate(test),
        model_metrics=metrics,
        totals=plan_totals(plan),
        plan=plan,
        top_features=model.importances(15) if isinstance(model, BoostedForecaster) else None,
        forecaster=model,
        features=features,
        mappings=mappings,
        train_rows=train_part.count(),
        test_rows=test.count(),
    )
    if folder:
        write_results(result, folder)
    return result


def summary_row(result: TrainingResult) -> DataFrame:
    parts = {
        "baseline_metrics": result.baseline_metrics,
        "model_metrics": result.model_metrics,
        "inventory_kpis": result.totals,
    }
    return artifacts.metrics_row(parts, result.top_features)


def write_results(result: TrainingResult, folder: str) -> None:
    if isinstance(result.forecaster, BoostedForecaster):
        result.forecaster.save(f"{folder}/models/boosted")
    artifacts.write_metrics(summary_row(result), f"{folder}/models/metrics")
    if result.mappings:
        artifacts.write_codes(result.mappings, f"{folder}/models/codes")
    artifacts.write_plan(result.plan, f"{folder}/data/processed/inventory_recommendations")
