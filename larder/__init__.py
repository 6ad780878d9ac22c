"""larder: demand-panel analytics on Spark DataFrames."""

from .config import DEFAULTS, BoostSpec, FeatureSpec, Settings, StockPolicy, WeekSplit
from .operators.boosted import BoostedForecaster
from .operators.forecast import Forecaster, MedianForecaster, score
from .operators.inventory import plan_totals, policy_replay, recommend, stock_plan
from .operators.profiles import sku_profiles
from .plans.adaptive import AdaptiveLoop, FeedbackLog
from .plans.backtest import Walk, backtest
from .plans.training import train
from .session import scratch
from .sources.tables import load_tables

__all__ = [
    "DEFAULTS",
    "AdaptiveLoop",
    "BoostSpec",
    "BoostedForecaster",
    "FeatureSpec",
    "FeedbackLog",
    "Forecaster",
    "MedianForecaster",
    "Settings",
    "StockPolicy",
    "Walk",
    "WeekSplit",
    "backtest",
    "load_tables",
    "plan_totals",
    "policy_replay",
    "recommend",
    "score",
    "scratch",
    "sku_profiles",
    "stock_plan",
    "train",
]
