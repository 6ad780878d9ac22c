"""Settings as frozen dataclasses; every operator takes what it needs from here or as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class StockPolicy:
    service_level: float = 0.95
    lead_time_weeks: int = 1
    min_safety_stock: float = 5.0


@dataclass(frozen=True)
class WeekSplit:
    train_end: int = 125
    val_end: int = 135
    total: int = 145


@dataclass(frozen=True)
class FeatureSpec:
    keys: tuple[str, ...] = ("center_id", "meal_id")
    target: str = "num_orders"
    lags: tuple[int, ...] = (1, 2, 3, 4, 5, 10)
    windows: tuple[int, ...] = (3, 5, 10)
    log_target: bool = True
    categorical: tuple[str, ...] = (
        "center_type",
        "category",
        "cuisine",
        "city_code",
        "region_code",
    )


@dataclass(frozen=True)
class BoostSpec:
    """Boosted-tree parameters; the comments name the MLlib parameter each one maps to."""

    trees: int = 600  # maxIter
    depth: int = 7  # maxDepth
    rate: float = 0.03  # stepSize
    row_share: float = 0.8  # subsamplingRate
    column_share: float = 0.8  # featureSubsetStrategy
    min_rows: int = 3  # minInstancesPerNode
    patience: int = 40
    seed: int = 42


@dataclass(frozen=True)
class Settings:
    split: WeekSplit = field(default_factory=WeekSplit)
    stock: StockPolicy = field(default_factory=StockPolicy)
    features: FeatureSpec = field(default_factory=FeatureSpec)
    boost: BoostSpec = field(default_factory=BoostSpec)


DEFAULTS = Settings()
