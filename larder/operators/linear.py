"""Linear forecaster by ridge regression, and what each feature adds to each single forecast."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import at_least, clean
from .boosted import NotFitted
from .forecast import FORECAST, Forecaster


@dataclass(frozen=True)
class LinearModel:
    means: dict[str, float]
    slopes: dict[str, float]
    base: float  # mean of the label


def gram(df: DataFrame, features: Sequence[str], label: Column) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means, and sums of the products of all centred columns; the label is the last column.

    Two aggregations that combine before the shuffle: whatever the rows, some ``len(features) ** 2`` numbers come
    back. Rows with a missing value take no part.
    """
    names = [f"v{i}" for i in range(len(features) + 1)]
    rows = df.select(*[clean(c).alias(v) for c, v in zip([*map(F.col, features), label], names, strict=True)]).dropna()
    first = rows.agg(F.count(F.lit(1)), *[F.avg(v) for v in names]).first()
    if not first[0]:
        return 0, np.zeros(len(names)), np.zeros((len(names), len(names)))
    centred = rows.select(*[(F.col(v) - F.lit(float(mean))).alias(v) for v, mean in zip(names, first[1:], strict=True)])
    places = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    sums = centred.agg(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in places]).first()
    out = np.zeros((len(names), len(names)))
    for (i, j), x in zip(places, sums, strict=True):
        out[i, j] = out[j, i] = x
    return first[0], np.array(first[1:]), out


class LinearForecaster(Forecaster):
    """Ridge regression on log1p of the target, clipped at 0.

    The penalty is ``l2`` times the sum of squares of each feature, so that it does not depend on units. A feature
    that never changes has slope 0. A missing feature counts as its mean. Without a full row all forecasts are 0.
    """

    def __init__(self, features: Sequence[str], l2: float = 1e-3, target: str = "num_orders", log_target: bool = True) -> None:
        self.features, self.l2, self.target, self.log_target = list(features), l2, target, log_target
        self.model: LinearModel | None = None

    def fit(self, df: DataFrame, validation: DataFrame | None = None) -> "LinearForecaster":
        missing = sorted(set(self.features) - set(df.columns))
        if missing:
            raise KeyError(f"missing feature columns: {missing[:5]}")
        label = F.log1p(self.target) if self.log_target else F.col(self.target)
        _, means, sums = gram(df, self.features, label)
        squares = np.diag(sums)[:-1]
        used = np.flatnonzero(squares > 1e-12 * np.maximum(1.0, means[:-1] ** 2))
        slopes = np.zeros(len(self.features))
        inner = sums[np.ix_(used, used)] + np.diag(self.l2 * squares[used])
        slopes[used] = np.linalg.lstsq(inner, sums[used, -1], rcond=None)[0]
        self.model = LinearModel(
            dict(zip(self.features, means[:-1].tolist())), dict(zip(self.features, slopes.tolist())), float(means[-1])
        )
        return self

    def parts(self) -> list[Column]:
        """What each feature adds to the raw forecast of a row: slope times the distance from the mean."""
        if self.model is None:
            raise NotFitted("fit the forecaster before using it")
        return [
            F.coalesce((clean(f) - F.lit(self.model.means[f])) * F.lit(self.model.slopes[f]), F.lit(0.0)) for f in self.features
        ]

    def raw(self) -> Column:
        return reduce(add, self.parts(), F.lit(self.model.base if self.model else 0.0))

    def transform(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise NotFitted("fit the forecaster before using it")
        value = F.expm1(self.raw()) if self.log_target else self.raw()
        return df.select(*[c for c in df.columns if c != FORECAST], at_least(value, 0.0).alias(FORECAST))

    def attribution(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``keys, feature, contribution`` for all rows: those of a row add up to its raw forecast less the mean."""
        each = [F.struct(F.lit(f).alias("feature"), p.alias("contribution")) for f, p in zip(self.features, self.parts(), strict=True)]
        return df.select(*keys, F.inline(F.array(*each)))


def mean_attribution(attribution: DataFrame) -> DataFrame:
    """``feature, mean_size, mean_contribution`` over all rows."""
    size = F.avg(F.abs("contribution"))
    return attribution.groupBy("feature").agg(size.alias("mean_size"), F.avg("contribution").alias("mean_contribution"))
