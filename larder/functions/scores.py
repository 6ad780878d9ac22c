"""Forecast error measures as aggregate Columns.

Because they are Columns and not functions over a collected array, the same text scores a whole table,
every backtest fold or every slice, with one partial aggregation on the map side.

The measures are also available in two steps: ``error_sums`` are plain sums that can be added up
again, ``from_sums`` turns added-up sums into the measures.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import at_least, col, half_up, is_finite


def _pair(actual, forecast):
    # The forecast is clipped before the finite check, so a forecast of -Inf counts as 0.
    y = col(actual).cast("double")
    p = at_least(col(forecast).cast("double"), 0.0)
    return y, p, is_finite(y) & is_finite(p)


def _log_gap(y: Column, p: Column) -> Column:
    return F.log1p(F.greatest(p, F.lit(0.0))) - F.log1p(F.greatest(y, F.lit(0.0)))


def error_sums(actual: str | Column, forecast: str | Column) -> list[Column]:
    y, p, ok = _pair(actual, forecast)
    gap = y - p
    log_gap = _log_gap(y, p)
    return [
        F.sum(F.when(ok, 1).otherwise(0)).alias("pairs"),
        F.sum(F.when(ok, F.abs(gap))).alias("abs_error"),
        F.sum(F.when(ok, gap * gap)).alias("sq_error"),
        F.sum(F.when(ok, log_gap * log_gap)).alias("sq_log_error"),
        F.sum(F.when(ok, F.abs(y))).alias("abs_actual"),
    ]


SUM_NAMES = ("pairs", "abs_error", "sq_error", "sq_log_error", "abs_actual")


def from_sums() -> dict[str, Column]:
    """The four measures over columns named as in ``SUM_NAMES``; 0 where there is nothing to score."""
    n = F.nullif(F.col("pairs"), F.lit(0))
    return {
        "mae": half_up(F.coalesce(F.col("abs_error") / n, F.lit(0.0)), 3),
        "rmse": half_up(F.coalesce(F.sqrt(F.col("sq_error") / n), F.lit(0.0)), 3),
        "wmape": half_up(
            F.when(F.col("abs_actual") > 0, F.col("abs_error") / F.col("abs_actual")).otherwise(0.0), 4
        ),
        "rmsle": half_up(F.coalesce(F.sqrt(F.col("sq_log_error") / n), F.lit(0.0)), 4),
    }


def add_sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in SUM_NAMES]


def wmape(actual: str | Column, forecast: str | Column) -> Column:
    """Weighted error on its own: nothing is clipped or rounded."""
    y, p = col(actual).cast("double"), col(forecast).cast("double")
    ok = is_finite(y) & is_finite(p)
    total = F.sum(F.when(ok, F.abs(y)))
    return F.when(total > 0, F.sum(F.when(ok, F.abs(y - p))) / total).otherwise(0.0)


def rmsle(actual: str | Column, forecast: str | Column) -> Column:
    """Root mean squared log error on its own: both sides are clipped at 0, nothing is rounded."""
    y = at_least(col(actual).cast("double"), 0.0)
    p = at_least(col(forecast).cast("double"), 0.0)
    ok = is_finite(y) & is_finite(p)
    gap = F.log1p(p) - F.log1p(y)
    return F.coalesce(F.sqrt(F.avg(F.when(ok, gap * gap))), F.lit(0.0))


def plain_rmse(actual: str | Column, forecast: str | Column) -> Column:
    """Root mean squared residual, unclipped; this is what the safety stock is built on."""
    gap = col(actual) - col(forecast)
    return F.sqrt(F.avg(gap * gap))
