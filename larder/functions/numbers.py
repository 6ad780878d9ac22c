"""Null, NaN and rounding rules shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: str | Column) -> Column:
    """NaN becomes NULL, so that one notion of "missing" is left."""
    c = col(c).cast("double")
    return F.when(~F.isnan(c), c)


def is_finite(c: str | Column) -> Column:
    """True for ordinary numbers; false for NULL, NaN and the infinities."""
    c = col(c).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def at_least(c: str | Column, floor: float | Column) -> Column:
    """max(c, floor) that keeps NULL (``greatest`` alone would skip it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor) if not isinstance(floor, Column) else floor))


def half_up(c: str | Column, digits: int) -> Column:
    """Round half away from zero on the decimal value.

    Going through a decimal keeps ties stable when the input carries the last-bit noise that sums of
    doubles have when the rows arrive in another order.
    """
    return F.round(col(c).try_cast("decimal(38,10)"), digits).cast("double")
