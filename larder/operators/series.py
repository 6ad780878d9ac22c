"""Lags and rolling statistics of a panel series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import FeatureSpec
from .heavy import LIGHT_ROWS, SPREAD, _all_set, cut_series

DEFAULT = FeatureSpec()


def lag_columns(target: str, lags: Sequence[int], window: WindowSpec, known: Column) -> list[Column]:
    return [
        F.when(known, F.lag(F.col(target).cast("double"), n).over(window)).alias(f"{target}_lag_{n}")
        for n in lags
    ]


def rolling_columns(target: str, windows: Sequence[int], window: WindowSpec, known: Column) -> list[Column]:
    """Mean and sample deviation of the k rows before the current one; a lone value deviates by 0."""
    y = F.col(target).cast("double")
    out = []
    for k in windows:
        frame = window.rowsBetween(-k, -1)
        out.append(F.when(known, F.avg(y).over(frame)).alias(f"{target}_roll_mean_{k}"))
        spread = F.when(known, F.stddev_samp(y).over(frame))
        out.append(F.coalesce(spread, F.lit(0.0)).alias(f"{target}_roll_std_{k}"))
    return out


def history_features(
    df: DataFrame,
    lags: Sequence[int] = DEFAULT.lags,
    windows: Sequence[int] = DEFAULT.windows,
    keys: Sequence[str] = DEFAULT.keys,
    target: str = DEFAULT.target,
    time: str = "week",
    tie: str | None = "id",
    one_row_per_week: bool = False,
    light_rows: int = LIGHT_ROWS,
) -> DataFrame:
    """Add lag and rolling columns; both are counted in rows, so a missing week is simply skipped.

    All columns share one window, hence one shuffle and one sort. Rows without a full key get no
    history and are spread over the tasks. A series too long for one task is cut into pieces first. ``one_row_per_week`` tells that a
    series cannot be long, its rows being weeks of the calendar (as after a group-by on the week), and
    saves the pass that looks for long ones.
    """
    low = [n for n in lags if n < 1]
    if low:
        raise ValueError(f"a lag must be at least 1 or it leaks the target, got {low[0]}")
    if not lags and not windows:
        return df
    order = [time, tie] if tie and tie in df.columns else [time]
    columns = df.columns
    if one_row_per_week:
        parts, source = list(keys), df
    else:
        reach = max([*lags, *windows])
        source = cut_series(df, keys, order, reach, [target], light_rows)
        parts = [*keys, "piece"]
    known = _all_set(keys)
    # Whatever stands beside a row without a key does not matter: its history is blank.
    apart = F.when(known, 0).otherwise(F.pmod(F.xxhash64(*order), F.lit(SPREAD)))
    window = Window.partitionBy(*parts, apart).orderBy(*order)
    added = lag_columns(target, lags, window, known) + rolling_columns(target, windows, window, known)
    out = source.select("*", *added)
    if not one_row_per_week:
        out = out.filter(~F.col("halo")).drop("piece", "halo")
    return out.select(*columns, *[f"{target}_lag_{n}" for n in lags], *[
        f"{target}_roll_{s}_{k}" for k in windows for s in ("mean", "std")
    ])


def lag_features(df: DataFrame, lags: Sequence[int] = DEFAULT.lags, **options) -> DataFrame:
    return history_features(df, lags=lags, windows=(), **options)


def rolling_features(df: DataFrame, windows: Sequence[int] = DEFAULT.windows, **options) -> DataFrame:
    return history_features(df, lags=(), windows=windows, **options)


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The last n rows of each group. Spark limits each group inside the map tasks before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)
