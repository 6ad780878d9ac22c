"""Price, discount and promotion expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import at_least, col

PRICE_FLOOR = 1e-4


def safe_base(base: str | Column = "base_price") -> Column:
    return F.greatest(F.coalesce(col(base), F.lit(1.0)), F.lit(PRICE_FLOOR))


def discount_amount(checkout="checkout_price", base="base_price") -> Column:
    return at_least(col(base) - col(checkout), 0.0)


def discount_ratio(checkout="checkout_price", base="base_price") -> Column:
    return discount_amount(checkout, base) / safe_base(base)


def price_ratio(checkout="checkout_price", base="base_price") -> Column:
    return col(checkout) / safe_base(base)


def plain_discount_ratio(checkout="checkout_price", base="base_price") -> Column:
    """(base - checkout) / base, not clipped; NULL where the base price is 0."""
    return (col(base) - col(checkout)) / F.nullif(col(base), F.lit(0.0))


def flag(c: str | Column) -> Column:
    return F.coalesce(col(c).cast("int"), F.lit(0)) == 1


def both_promos(email="emailer_for_promotion", home="homepage_featured") -> Column:
    return (flag(email) & flag(home)).cast("int")


def any_promo(email="emailer_for_promotion", home="homepage_featured") -> Column:
    return (flag(email) | flag(home)).cast("int")
