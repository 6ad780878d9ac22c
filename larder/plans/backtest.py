"""Walk-forward backtests."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from ..operators.forecast import FORECAST, Forecaster, count_medians, score, target_counts
from ..functions.numbers import at_least
from ..operators.slices import sliced_scores
from ..sources.staging import stage


_BAND = "_train_band"


@dataclass(frozen=True)
class Walk:
    """How the folds are laid out; the newest fold ends at the last week."""

    folds: int = 3
    test_weeks: int = 10
    min_train_weeks: int = 50
    expanding: bool = True
    time: str = "week"
    target: str = "num_orders"


@dataclass(frozen=True)
class Backtest:
    predictions: DataFrame
    folds: DataFrame
    overall: DataFrame
    slices: DataFrame


def fold_table(df: DataFrame, walk: Walk = Walk()) -> DataFrame:
    """(fold_index, train_start, train_end, test_start, test_end), one row per fold.

    Bounds count back from the last week in calendar weeks. With too few distinct weeks the test window
    shrinks, but not below 2.
    """
    n = walk.folds
    facts = df.agg(
        F.min(walk.time).alias("low"), F.max(walk.time).alias("high"), F.count_distinct(walk.time).alias("weeks")
    )
    short = F.col("weeks") < F.lit(walk.min_train_weeks + n * walk.test_weeks)
    smaller = F.greatest(F.lit(2), F.floor((F.col("weeks") - walk.min_train_weeks) / n))
    width = F.when(short, smaller).otherwise(F.lit(walk.test_weeks)).cast("int")

    def fold(i: Column) -> Column:
        test_end = F.col("high") - (F.lit(n - 1) - i) * F.col("width")
        test_start = test_end - F.col("width") + 1
        train_end = test_start - 1
        earliest = F.col("low") if walk.expanding else F.greatest("low", train_end - walk.min_train_weeks + 1)
        return F.struct(
            (i + 1).cast("int").alias("fold_index"),
            earliest.cast("int").alias("train_start"),
            train_end.cast("int").alias("train_end"),
            test_start.cast("int").alias("test_start"),
            test_end.cast("int").alias("test_end"),
        )

    return (
        facts.withColumn("width", width)
        .filter("high IS NOT NULL")
        .select(F.inline(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), fold)))
    )


def fold_bounds(df: DataFrame, walk: Walk = Walk()) -> list:
    """The fold table on the driver: as many rows as folds were asked for."""
    return fold_table(df, walk).collect()


def in_folds(df: DataFrame, bounds: list, part: str, walk: Walk = Walk()) -> DataFrame:
    """Rows with the index of every fold whose train or test weeks hold them.

    The bounds are literals, so the rows need no join and the outer week range reaches the scan.
    """
    if not bounds:
        return df.withColumn("fold_index", F.lit(None).cast("int")).limit(0)
    start, end = f"{part}_start", f"{part}_end"
    week = F.col(walk.time)
    matches = F.array_compact(
        F.array(*[F.when(week.between(b[start], b[end]), F.lit(b["fold_index"])) for b in bounds])
    )
    outer = week.between(min(b[start] for b in bounds), max(b[end] for b in bounds))
    return df.filter(outer).withColumn("fold_index", F.explode(matches))


def train_bands(bounds: list) -> list[tuple[int, int, list[int]]]:
    """(first week, last week, folds): stretches of weeks that the same folds train on, none of them twice."""
    edges = sorted({b["train_start"] for b in bounds} | {b["train_end"] + 1 for b in bounds})
    bands = []
    for start, after in zip(edges, edges[1:]):
        folds = [b["fold_index"] for b in bounds if b["train_start"] <= start and after - 1 <= b["train_end"]]
        if folds:
            bands.append((start, after - 1, folds))
    return bands


def fold_counts(df: DataFrame, bounds: list, keys: Sequence[str], walk: Walk = Walk()) -> DataFrame:
    """(fold_index, keys, value, weight): the target values that each fold trains on and how often.

    Training rows are counted once, by key and band of weeks, and the counts of the bands are dealt to the folds;
    a value stands in a fold once for each of its bands. A missing target is a null value.
    """
    bands = train_bands(bounds)
    week = F.col(walk.time)
    if not bands:
        empty = target_counts(df.limit(0), keys, walk.target)
        return empty.select(F.lit(None).cast("int").alias("fold_index"), *empty.columns)
    number = reduce(
        lambda chain, i: chain.when(week <= bands[i][1], F.lit(i)), range(1, len(bands)), F.when(week <= bands[0][1], F.lit(0))
    )
    # Bands that no fold trains on lie between two others only if the folds leave a gap; their weeks are left out here.
    used = reduce(lambda a, b: a | b, [week.between(start, end) for start, end, _ in bands])
    outer = week.between(bands[0][0], bands[-1][1])
    banded = df.filter(outer & used).withColumn(_BAND, number)
    counts = target_counts(banded, [_BAND, *keys], walk.target)
    folds = F.array(*[F.array(*[F.lit(f) for f in folds]) for _, _, folds in bands])
    return counts.withColumn("fold_index", F.explode(F.get(folds, F.col(_BAND)))).drop(_BAND)


def fold_scores(
    predictions: DataFrame, train_rows: DataFrame, bounds: list, walk: Walk = Walk()
) -> DataFrame:
    """Bounds, sample counts and measures of each fold that has both train and test rows."""
    spark = predictions.sparkSession
    names = ("fold_index", "train_start", "train_end", "test_start", "test_end")
    table = spark.createDataFrame([tuple(b[n] for n in names) for b in bounds], ", ".join(f"{n} int" for n in names))
    sums = predictions.groupBy("fold_index").agg(
        F.count(F.lit(1)).alias("test_samples"), *scores.error_sums(walk.target, FORECAST)
    )
    # Every side has one row per fold.
    joined = table.join(F.broadcast(train_rows), "fold_index").join(F.broadcast(sums), "fold_index")
    return joined.select(*names, "train_samples", "test_samples", *[c.alias(n) for n, c in scores.from_sums().items()])


def median_predictions(
    df: DataFrame, bounds: list, keys: Sequence[str] = ("center_id", "meal_id"), walk: Walk = Walk()
) -> tuple[DataFrame, DataFrame]:
    """Median baseline of all folds in one plan: (predictions, training rows per fold).

    The training rows are read once, whatever the number of folds.
    """
    keys = list(keys)
    counts = fold_counts(df, bounds, keys, walk)
    train_rows = counts.groupBy("fold_index").agg(F.sum("weight").alias("train_samples"))
    levels = count_medians(counts, keys, by=["fold_index"])
    medians = levels.filter("level = 1").select("fold_index", *keys, F.col("median").alias("group_median"))
    overall = levels.filter("level = 0").select("fold_index", F.col("median").alias("overall_median"))
    # One row per fold; the inner join leaves out folds without training rows.
    test = in_folds(df, bounds, "test", walk).join(F.broadcast(overall), "fold_index")
    found = test.join(medians, ["fold_index", *keys], "left")
    forecast = at_least(F.coalesce("group_median", "overall_median"), 0.0)
    return found.select(*df.columns, "fold_index", forecast.alias(FORECAST)), train_rows


def model_predictions(
    df: DataFrame, bounds: list, factory: Callable[[], Forecaster], walk: Walk = Walk()
) -> tuple[DataFrame, DataFrame]:
    """A fresh model per fold; each fit and score is distributed, only the folds follow each other."""
    week = F.col(walk.time)
    parts, counts = [], []
    for b in bounds:
        train = df.filter(week.between(b["train_start"], b["train_end"]))
        test = df.filter(week.between(b["test_start"], b["test_end"]))
        n = train.count()
        if n and not test.isEmpty():
            scored = factory().fit(train).transform(test)
            parts.append(stage(scored.withColumn("fold_index", F.lit(b["fold_index"])), "fold"))
            counts.append((b["fold_index"], n))
    if not parts:
        raise ValueError("no fold has both training and test rows")
    rows = df.sparkSession.createDataFrame(counts, "fold_index int, train_samples bigint")
    return reduce(DataFrame.unionByName, parts), rows


def backtest(
    df: DataFrame,
    factory: Callable[[], Forecaster] | None = None,
    keys: Sequence[str] = ("center_id", "meal_id"),
    walk: Walk = Walk(),
) -> Backtest:
    """Predictions of every fold and their measures per fold, overall and per slice.

    Without a factory the median baseline is used, with all folds in one plan.
    """
    bounds = fold_bounds(df, walk)
    if factory is None:
        predictions, train_rows = median_predictions(df, bounds, keys, walk)
    else:
        predictions, train_rows = model_predictions(df, bounds, factory, walk)
    predictions = stage(predictions, "backtest")
    if factory is None and predictions.isEmpty():
        raise ValueError("no fold has both training and test rows")
    return Backtest(
        predictions,
        fold_scores(predictions, train_rows, bounds, walk),
        score(predictions, walk.target),
        sliced_scores(predictions, walk.target),
    )
