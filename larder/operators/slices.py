"""Error measures per value of several dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from .forecast import FORECAST

DIMENSIONS = ("center_type", "category", "cuisine", "emailer_for_promotion", "homepage_featured")
MIN_ROWS = 5


def sliced_scores(
    df: DataFrame,
    actual: str = "num_orders",
    forecast: str = FORECAST,
    dimensions: Sequence[str] = DIMENSIONS,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """(dimension, slice, sample_count, measures) for every slice with enough rows.

    The sums are formed once per combination of all dimensions and then added up per dimension, so the
    table is read once and not multiplied by the number of dimensions.
    """
    present = [d for d in dimensions if d in df.columns]
    if not present:
        # Nothing to slice by: the same columns without a row.
        none = df.agg(F.count(F.lit(1)).alias("rows"), *scores.error_sums(actual, forecast)).filter("false")
        text = F.lit(None).cast("string")
        return none.select(
            text.alias("dimension"), text.alias("slice"), F.col("rows").alias("sample_count"), *[c.alias(n) for n, c in scores.from_sums().items()]
        )
    combined = df.groupBy(*present).agg(F.count(F.lit(1)).alias("rows"), *scores.error_sums(actual, forecast))
    views = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("slice")) for d in present]
    )
    sums = (
        combined.select(F.inline(views), "rows", *scores.SUM_NAMES)
        .filter("slice IS NOT NULL")
        .groupBy("dimension", "slice")
        .agg(F.sum("rows").alias("sample_count"), *scores.add_sums())
        .filter(F.col("sample_count") >= min_rows)
    )
    return sums.select("dimension", "slice", "sample_count", *[c.alias(n) for n, c in scores.from_sums().items()])
