"""Price, promotion and calendar features, category codes and the complete feature frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..config import FeatureSpec
from ..functions import pricing, weeks
from ..functions.numbers import at_least
from ..sources.staging import stage
from .heavy import PIECES
from .series import history_features


def enrich(fact: DataFrame, centers: DataFrame, meals: DataFrame, how: str = "left") -> DataFrame:
    """Join the metadata. The planner broadcasts a dimension when its size allows it; beyond that it is
    a shuffle join whose skewed partitions are split at run time."""
    return fact.join(centers, "center_id", how).join(meals, "meal_id", how)


def price_features(df: DataFrame) -> DataFrame:
    if not {"checkout_price", "base_price"} <= set(df.columns):
        return df
    return df.withColumns(
        {
            "discount_amount": pricing.discount_amount(),
            "discount_ratio": pricing.discount_ratio(),
            "price_ratio": pricing.price_ratio(),
        }
    )


def meal_means(df: DataFrame) -> DataFrame:
    means = df.filter("meal_id IS NOT NULL").groupBy("meal_id")
    return stage(means.agg(F.avg("checkout_price").alias("meal_mean_price")), "meal-means")


def relative_price(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """``meal_rel_price``: price over the mean price of the meal.

    The means are aggregated (with map-side combine) and joined back, so the fact table is not shuffled
    by meal. By default they cover the whole frame, later weeks included; ``fit_on`` limits them.
    """
    if not {"checkout_price", "base_price", "meal_id"} <= set(df.columns):
        return df
    means = meal_means(df if fit_on is None else fit_on)
    return (
        df.join(means, "meal_id", "left")
        .withColumn(
            "meal_rel_price", F.col("checkout_price") / at_least("meal_mean_price", pricing.PRICE_FLOOR)
        )
        .select(*df.columns, "meal_rel_price")
    )


def promo_features(df: DataFrame) -> DataFrame:
    if not {"emailer_for_promotion", "homepage_featured"} <= set(df.columns):
        return df
    df = df.withColumns({"both_promos": pricing.both_promos(), "any_promo": pricing.any_promo()})
    if "discount_ratio" in df.columns:
        df = df.withColumn("promo_discount_synergy", F.col("any_promo") * F.col("discount_ratio"))
    return df


def calendar_features(df: DataFrame, time: str = "week") -> DataFrame:
    if time not in df.columns:
        return df
    return df.withColumns(
        {
            "week_of_year": weeks.week_of_year(time),
            "month_proxy": weeks.month_number(time),
            "quarter_proxy": weeks.quarter_number(time),
            "sin_week_of_year": weeks.season_sine(time),
            "cos_week_of_year": weeks.season_cosine(time),
        }
    )


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): position of each distinct value in sorted order, starting at 0.

    Numbers sort as numbers. The distinct values are ranked in pieces, cut at a fixed-size sample of the
    values themselves, and the pieces' offsets are added up; so a column with very many values does not
    end up in one task.
    """
    values = df.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct()
    sample = values.orderBy(F.xxhash64("value"), "value").limit(PIECES - 1)
    points = sample.agg(F.array_sort(F.collect_list("value"))).scalar()
    piece = F.size(F.filter("points", lambda s: s < F.col("value")))
    values = values.withColumn("points", points).withColumn("piece", piece).drop("points")
    # At most PIECES rows are numbered by the window without a partition.
    sizes = values.groupBy("piece").agg(F.count(F.lit(1)).alias("inside"))
    before = F.sum("inside").over(Window.orderBy("piece")) - F.col("inside")
    offsets = sizes.select("piece", before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("piece").orderBy("value"))
    return values.join(F.broadcast(offsets), "piece").select(
        "value", (F.col("before") + rank - 1).cast("int").alias("code")
    )


def encode(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Replace a column by its code; unseen and missing values become -1."""
    table = codes.select(F.col("value").alias(column), F.col("code"))
    coded = df.join(table, column, "left").withColumn(column, F.coalesce("code", F.lit(-1)))
    return coded.select(*df.columns)


def encode_categories(
    df: DataFrame, columns: Sequence[str], mappings: Mapping[str, DataFrame] | None = None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Encode the columns that are present; given mappings are used as they are, others are fitted.

    One pass finds the distinct combinations of all columns to fit; the codes are worked out on those.
    """
    tables = dict(mappings or {})
    present = [c for c in columns if c in df.columns]
    to_fit = [c for c in present if c not in tables]
    if to_fit:
        combinations = stage(df.select(*to_fit).distinct(), "categories")
        tables |= {c: stage(category_codes(combinations, c), f"codes-{c}") for c in to_fit}
    for column in present:
        df = encode(df, column, tables[column])
    return df, tables


def feature_columns(df: DataFrame, target: str = "num_orders") -> list[str]:
    return [c for c in df.columns if c not in ("id", "_target", target)]


def impute_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    chosen = [c for c in (columns or feature_columns(df)) if isinstance(df.schema[c].dataType, NumericType)]
    return df.fillna(0, subset=chosen) if chosen else df


def feature_frame(
    df: DataFrame,
    spec: FeatureSpec = FeatureSpec(),
    mappings: Mapping[str, DataFrame] | None = None,
    impute: bool = True,
    one_row_per_week: bool = False,
    fit_on: DataFrame | None = None,
    metadata: tuple[DataFrame, DataFrame] | None = None,
) -> tuple[DataFrame, list[str], dict[str, DataFrame]]:
    """All features in order: price, promotion, calendar, codes, history (if the target is there).

    Returns the frame, the names of the feature columns and the category tables. ``fit_on`` limits the meal
    means to some rows, such as the training weeks. ``metadata`` holds centers and meals to join (``enrich``); given
    here instead of joined before, their columns stay out of the history's shuffle.
    """
    past = spec.target in df.columns

    def history(rows: DataFrame) -> DataFrame:
        return history_features(rows, spec.lags, spec.windows, spec.keys, spec.target, one_row_per_week=one_row_per_week)

    def derived(rows: DataFrame) -> DataFrame:
        return calendar_features(promo_features(relative_price(price_features(rows), df if fit_on is None else fit_on)))

    if metadata:
        # History first, so that its shuffle carries the columns of ``df`` only. For a frame that is written as it is.
        _, tables = encode_categories(enrich(df, *metadata), spec.categorical, mappings)
        out = history(df) if past else df
        added = out.columns[len(df.columns) :]
        out, _ = encode_categories(derived(enrich(out, *metadata)), spec.categorical, tables)
        out = out.select(*[c for c in out.columns if c not in added], *added)
    else:
        # History last, so that its shuffle carries the codes, and no later step repeats the other features' expressions.
        out, tables = encode_categories(derived(df), spec.categorical, mappings)
        out = history(out) if past else out
    names = feature_columns(out, spec.target)
    return (impute_zero(out, names) if impute else out), names, tables
