"""Calendar expressions on an integer week number."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col


def week_of_year(week: str | Column = "week") -> Column:
    return (F.pmod(col(week) - 1, F.lit(52)) + 1).cast("int")


def month_number(week: str | Column = "week") -> Column:
    return (F.pmod(F.floor((col(week) - 1) / 4), F.lit(12)) + 1).cast("int")


def quarter_number(week: str | Column = "week") -> Column:
    return (F.pmod(F.floor((col(week) - 1) / 13), F.lit(4)) + 1).cast("int")


def _angle(week: str | Column) -> Column:
    return F.lit(2 * math.pi) * week_of_year(week) / F.lit(52.0)


def season_sine(week: str | Column = "week") -> Column:
    return F.sin(_angle(week))


def season_cosine(week: str | Column = "week") -> Column:
    return F.cos(_angle(week))
