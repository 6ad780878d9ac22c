"""Distribution drift of many features at once.

Both sides are turned into one table of (feature, value, rows in baseline, rows in current), which serves PSI and
Kolmogorov-Smirnov of all features together; a value that occurs often is one row of it, and the values of a feature
are ordered in pieces (see ``heavy``). ``side_counts`` makes it of every value. ``drift_counts`` counts the rows by cells of
an even grid first, which combines inside the tasks, and splits only those cells into values that can hold a bin edge or
the largest distance; the measures are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import half_up, is_finite
from ..sources.staging import stage
from .heavy import LIGHT_ROWS, cumulate, exact_quantiles

BINS = 10
# Thresholds of the drift rules.
PSI_THRESHOLD, PSI_HIGH, PSI_AMBER = 0.20, 0.25, 0.10
KS_ALPHA, KS_MIN_DISTANCE, KS_MIN_ROWS = 0.01, 0.15, 5
SHARE_FLOOR, PSI_CAP = 1e-4, 10.0
CRITICAL_SHARE, MODERATE_SHARE, CRITICAL_RATIO = 0.35, 0.15, 1.8


def two_sides(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One frame with a ``side`` label; columns missing on either side are left out."""
    both = [c for c in columns if c in baseline.columns and c in current.columns]

    def one(df: DataFrame, side: str) -> DataFrame:
        return df.select(F.lit(side).alias("side"), *[F.col(c).cast("double").alias(c) for c in both])

    return one(baseline, "baseline").unionByName(one(current, "current"))


def side_counts(sided: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, baseline_rows, current_rows) over finite values of a frame with ``side``.

    Each feature also has a row without a value and without rows, so that none gets lost for want of finite values.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    long = sided.select("side", F.inline(pairs)).filter(is_finite("value"))
    # -0.0 and 0.0 are one value
    counts = long.groupBy("feature", (F.col("value") + F.lit(0.0)).alias("value")).agg(
        F.count_if(F.col("side") == "baseline").alias("baseline_rows"),
        F.count_if(F.col("side") == "current").alias("current_rows"),
    )
    return counts.unionByName(_without_values(sided.sparkSession, features))


def _without_values(spark: SparkSession, features: Sequence[str]) -> DataFrame:
    every = spark.createDataFrame([(f,) for f in features], "feature string")
    none = F.lit(0).cast("bigint")
    return every.select("feature", F.lit(None).cast("double").alias("value"), none.alias("baseline_rows"), none.alias("current_rows"))


GRID = 65_536  # cells per feature


def _gridded(sided: DataFrame, features: Sequence[str], grid: int) -> DataFrame:
    """(side, at, cell, value), one row per finite value; ``at`` is the feature's position, cells grow with the value."""
    pairs = [F.struct(F.lit(i).alias("at"), F.col(f).cast("double").alias("value")) for i, f in enumerate(features)]
    long = sided.select("side", F.inline(F.array(*pairs))).filter(is_finite("value"))
    # -0.0 and 0.0 are one value
    rows = long.select("side", "at", (F.col("value") + F.lit(0.0)).alias("value"))
    # One row per feature.
    ends = {r["at"]: r for r in rows.groupBy("at").agg(F.min("value").alias("low"), F.max("value").alias("high")).collect()}
    # Halved, so that the width is finite. Each step is rounded, but never turns the order round.
    lows = [ends[i]["low"] / 2 if i in ends else 0.0 for i in range(len(features))]
    widths = [ends[i]["high"] / 2 - ends[i]["low"] / 2 if i in ends else 0.0 for i in range(len(features))]

    def of_feature(numbers: list[float]) -> Column:
        return F.get(F.array(*[F.lit(n) for n in numbers]), F.col("at"))

    share = F.try_divide(F.col("value") / 2 - of_feature(lows), of_feature(widths))
    cell = F.coalesce(F.least(F.floor(share * grid), F.lit(grid - 1)), F.lit(0))
    return rows.select("side", "at", cell.cast("int").alias("cell"), "value")


def _opened(bins: int) -> Column:
    """Whether the values of a cell must be known, from the cell's rows and the running ones of both sides.

    A bin edge lies between two neighbouring positions of the baseline: the cells that hold them and those between are
    opened. Inside a cell the distance is at most that of one side's end from the other's start; a cell where this is
    below the largest distance at the end of any cell can't hold a larger one, nor can one that has rows of one side only.
    The first and last cell of either side are opened for its smallest and largest value.
    """

    def holds(side: str, first: Column, last: Column) -> Column:
        return (F.col(f"{side}_upto") - F.col(f"{side}_rows") <= last) & (F.col(f"{side}_upto") > first)

    opened = F.lit(False)
    for i in range(bins + 1):
        place = F.lit(i / bins) * (F.col("baseline_n") - 1)
        opened = opened | holds("baseline", F.floor(place), F.ceil(place))
    for end in (F.lit(0), F.col("current_n") - 1):
        opened = opened | holds("current", end, end)

    def share(side: str, at_end: bool) -> Column:
        upto = F.col(f"{side}_upto") if at_end else F.col(f"{side}_upto") - F.col(f"{side}_rows")
        return F.try_divide(upto, F.col(f"{side}_n"))

    farthest = F.greatest(
        F.abs(share("baseline", True) - share("current", False)), F.abs(share("baseline", False) - share("current", True))
    )
    reached = F.max(F.abs(share("baseline", True) - share("current", True))).over(Window.partitionBy("at"))
    both = (F.col("baseline_rows") > 0) & (F.col("current_rows") > 0)
    far = both & F.coalesce(farthest >= reached - 1e-12, F.lit(True))
    return (F.col("lowest") < F.col("value")) & (opened | far)


def drift_counts(sided: DataFrame, features: Sequence[str], bins: int = BINS, grid: int = GRID) -> DataFrame:
    """``side_counts`` with fewer rows and the same PSI (of ``bins``) and KS, written.

    A cell of the grid that holds neither is one row with its largest value. What is shuffled are the cells
    of each task and the values of the opened cells; if values stand so unevenly that few cells hold them all, that is
    every value, as with ``side_counts``.
    """
    rows = _gridded(sided, features, grid)
    both = [F.count_if(F.col("side") == side).alias(f"{side}_rows") for side in ("baseline", "current")]
    cells = rows.groupBy("at", "cell").agg(*both, F.min("value").alias("lowest"), F.max("value").alias("value"))
    # At most `grid` rows per feature.
    whole = Window.partitionBy("at")
    upto = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    for side in ("baseline", "current"):
        cells = cells.withColumn(f"{side}_upto", F.sum(f"{side}_rows").over(upto))
        cells = cells.withColumn(f"{side}_n", F.sum(f"{side}_rows").over(whole))
    cells = stage(cells.withColumn("opened", _opened(bins)), "cells")
    wanted = stage(cells.filter("opened").select("at", "cell"), "opened-cells")
    values = rows.join(wanted, ["at", "cell"], "left_semi").groupBy("at", "value").agg(*both)
    kept = cells.filter("NOT opened").select(*values.columns).unionByName(values)
    name = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("at") + 1)
    counts = kept.select(name.alias("feature"), "value", "baseline_rows", "current_rows")
    return stage(counts.unionByName(_without_values(sided.sparkSession, features)), "side-counts")


def side_totals(counts: DataFrame) -> DataFrame:
    """Per feature: rows and smallest and largest value of each side."""
    out = []
    for side in ("baseline", "current"):
        here = F.when(F.col(f"{side}_rows") > 0, F.col("value"))
        out += [
            F.sum(f"{side}_rows").alias(f"{side}_n"),
            F.min(here).alias(f"{side}_min"),
            F.max(here).alias(f"{side}_max"),
        ]
    return counts.groupBy("feature").agg(*out)


def psi(counts: DataFrame, bins: int = BINS, light_rows: int = LIGHT_ROWS, pieces: int | None = None) -> DataFrame:
    """(feature, psi): population stability index against quantile bins of the baseline."""
    edges = exact_quantiles(
        counts,
        ["feature"],
        [i / bins for i in range(bins + 1)],
        "baseline_rows",
        light_rows=light_rows,
        pieces=pieces,
    ).select("feature", F.array_sort(F.array_distinct("quantiles")).alias("edges"))
    # One row of at most bins + 1 numbers per feature.
    edges = stage(edges, "edges")
    binned = counts.join(F.broadcast(edges), "feature").withColumn(
        "bin",
        F.size(F.filter(F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0))), lambda e: e <= F.col("value"))),
    )
    shares = (
        binned.groupBy("feature", "bin")
        .agg(
            F.sum("baseline_rows").alias("e"),
            F.sum("current_rows").alias("a"),
            F.first(F.size("edges")).alias("n_edges"),
        )
        .join(
            F.broadcast(counts.groupBy("feature").agg(F.sum("baseline_rows").alias("en"), F.sum("current_rows").alias("an"))),
            "feature",
        )
        .filter("en > 0 AND an > 0 AND n_edges >= 2")
        .withColumn("e", F.greatest(F.col("e") / F.col("en"), F.lit(SHARE_FLOOR)))
        .withColumn("a", F.greatest(F.col("a") / F.col("an"), F.lit(SHARE_FLOOR)))
    )
    found = shares.groupBy("feature").agg(
        F.least(
            F.greatest(F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))), F.lit(0.0)), F.lit(PSI_CAP)
        ).alias("psi")
    )
    every = counts.select("feature").distinct()
    return every.join(found, "feature", "left").select("feature", F.coalesce("psi", F.lit(0.0)).alias("psi"))


EXACT_CELLS = 10_000  # of the lattice that an exact p-value goes through; beyond it the series is close


def ks_p_value(distance: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of the two-sample statistic."""
    n, m = n.cast("double"), m.cast("double")
    reach = distance * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.lit(-2.0) * k * k * reach * reach),
    )
    # The series converges slowly near 0, where the probability is 1 anyway.
    return F.when(reach < 0.2, 1.0).otherwise(F.least(F.greatest(series * 2, F.lit(0.0)), F.lit(1.0)))


def exact_ks_p_value(distance: Column, n: Column, m: Column) -> Column:
    """Exact two-sided p-value of the two-sample statistic, for samples without ties.

    Ordering both samples is a walk from (0, 0) to (n, m); the p-value is the share of all walks that somewhere get
    as far from the diagonal as the distance. The share of the walks to (i, j) that do is 1 if (i, j) is as far,
    else the mean of those of its two predecessors, weighted by i and j: one row of the lattice follows from the last.
    """
    n, m = n.cast("long"), m.cast("long")
    reach = F.round(distance * n * m).cast("long")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    def share(far: Column, otherwise: Column) -> Column:
        return F.when(far, 1.0).otherwise(otherwise)

    def next_row(row: Column, i: Column) -> Column:
        def add(done: Column, j: Column) -> Column:
            mean = (i * F.get(row, j.cast("int")) + j * F.element_at(done, -1)) / (i + j)
            return F.concat(done, F.array(share(F.abs(i * m - j * n) >= reach, mean)))

        return F.aggregate(F.sequence(one, m), F.array(share(i * m >= reach, F.lit(0.0))), add)

    start = F.transform(F.sequence(zero, m), lambda j: share(j * n >= reach, F.lit(0.0)))
    return F.element_at(F.aggregate(F.sequence(one, n), start, next_row), -1)


def two_sample_p_value(distance: Column, n: Column, m: Column, exact_cells: int | None = None) -> Column:
    """The exact p-value where the lattice has at most ``exact_cells`` cells (n times m), the asymptotic one beyond."""
    small = n.cast("double") * m.cast("double") <= (EXACT_CELLS if exact_cells is None else exact_cells)
    return F.when(small, exact_ks_p_value(distance, n, m)).otherwise(ks_p_value(distance, n, m))


def ks_test(counts: DataFrame, pieces: int | None = None) -> DataFrame:
    """(feature, ks_statistic, ks_p_value): two-sample Kolmogorov-Smirnov test."""
    totals = side_totals(counts)
    steps = cumulate(counts, "feature", ["baseline_rows", "current_rows"], pieces)
    # One row per feature.
    gaps = steps.join(F.broadcast(totals.select("feature", "baseline_n", "current_n")), "feature").select(
        "feature",
        F.abs(
            F.try_divide(F.col("upto_baseline_rows"), F.col("baseline_n"))
            - F.try_divide(F.col("upto_current_rows"), F.col("current_n"))
        ).alias("gap"),
    )
    distance = gaps.groupBy("feature").agg(F.max("gap").alias("distance"))
    enough = (F.col("baseline_n") > KS_MIN_ROWS) & (F.col("current_n") > KS_MIN_ROWS)
    constant = (F.col("baseline_min") == F.col("baseline_max")) & (F.col("current_min") == F.col("current_max"))
    same = F.col("baseline_min") == F.col("current_min")
    return totals.join(distance, "feature").select(
        "feature",
        F.when(~enough, 0.0)
        .when(constant, F.when(same, 0.0).otherwise(1.0))
        .otherwise(F.col("distance"))
        .alias("ks_statistic"),
        F.when(~enough, 1.0)
        .when(constant, F.when(same, 1.0).otherwise(0.0))
        .otherwise(two_sample_p_value(F.col("distance"), F.col("baseline_n"), F.col("current_n")))
        .alias("ks_p_value"),
    )


def judge(
    psi_scores: DataFrame, ks_scores: DataFrame, psi_threshold: float = PSI_THRESHOLD, alpha: float = KS_ALPHA
) -> DataFrame:
    """Drift flag and severity per feature."""
    drifted = (F.col("psi") >= psi_threshold) | (
        (F.col("ks_p_value") < alpha) & (F.col("ks_statistic") > KS_MIN_DISTANCE)
    )
    return psi_scores.join(ks_scores, "feature").select(
        "feature",
        "psi",
        "ks_statistic",
        "ks_p_value",
        drifted.alias("is_drifted"),
        F.when(~drifted, "NONE").when(F.col("psi") >= PSI_HIGH, "HIGH").otherwise("LOW").alias("severity"),
    )


def feature_drift(
    sided: DataFrame, features: Sequence[str], psi_threshold: float = PSI_THRESHOLD, alpha: float = KS_ALPHA
) -> DataFrame:
    """PSI, KS and verdict of every feature of a frame labelled with ``side``."""
    counts = drift_counts(sided, features)
    return judge(psi(counts), ks_test(counts), psi_threshold, alpha)


def target_drift(sided: DataFrame, target: str = "num_orders") -> DataFrame:
    """One row ``target_p_value``; null when a side has too few rows."""
    counts = drift_counts(sided, [target])
    totals = side_totals(counts)
    found = ks_test(counts).join(totals, "feature")
    enough = (F.col("baseline_n") > KS_MIN_ROWS) & (F.col("current_n") > KS_MIN_ROWS)
    # Two equal constants have distance 0, two different ones distance 1; unlike a feature, the target
    # gets the p-value of that distance.
    distance = F.col("ks_statistic")
    p = F.when(enough, two_sample_p_value(distance, F.col("baseline_n"), F.col("current_n")))
    return found.agg(F.max(p).alias("target_p_value"))


def residual_variance_ratio(
    sided: DataFrame, actual: str = "num_orders", forecast: str = "forecast_orders"
) -> DataFrame:
    """One row: population variance of the residuals, current over baseline."""
    residual = F.col(actual) - F.col(forecast)
    both = sided.agg(
        F.var_pop(F.when(F.col("side") == "baseline", residual)).alias("b"),
        F.var_pop(F.when(F.col("side") == "current", residual)).alias("c"),
    )
    return both.select(F.when(F.col("b") > 0, F.col("c") / F.col("b")).alias("residual_variance_ratio"))


def drift_status(drift: DataFrame, target_p: DataFrame | None = None, ratio: DataFrame | None = None) -> DataFrame:
    """Overall verdict in one row, from feature drift, target p-value and residual variance ratio."""
    p = target_p.scalar() if target_p is not None else F.lit(None).cast("double")
    r = ratio.scalar() if ratio is not None else F.lit(None).cast("double")
    summary = drift.agg(
        F.count_if("is_drifted").cast("bigint").alias("drifted_features"), F.count(F.lit(1)).alias("features")
    )
    summary = summary.withColumn("target_p_value", p).withColumn("residual_variance_ratio", r)
    share = F.col("drifted_features") / F.greatest(F.lit(1), F.col("features"))
    critical = (share > CRITICAL_SHARE) | F.coalesce(F.col("residual_variance_ratio") > CRITICAL_RATIO, F.lit(False))
    moderate = (share > MODERATE_SHARE) | F.coalesce(F.col("target_p_value") < KS_ALPHA, F.lit(False))
    status = F.when(critical, "CRITICAL_DRIFT").when(moderate, "MODERATE_DRIFT").otherwise("HEALTHY")
    return summary.select(status.alias("status"), *summary.columns)


def drift_report(
    sided: DataFrame,
    features: Sequence[str],
    target: str | None = "num_orders",
    residual_ratio: DataFrame | None = None,
    psi_threshold: float = PSI_THRESHOLD,
    alpha: float = KS_ALPHA,
) -> DataFrame:
    """The whole assessment as one nested row; its array has one entry per feature."""
    present = [f for f in features if f in sided.columns]
    drift = stage(feature_drift(sided, present, psi_threshold, alpha), "drift")
    target_p = target_drift(sided, target) if target and target in sided.columns else None
    status = drift_status(drift, target_p, residual_ratio)
    order = F.create_map(*[x for i, f in enumerate(present) for x in (F.lit(f), F.lit(i))])
    entries = drift.agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    order[F.col("feature")].alias("position"),
                    F.col("feature").alias("name"),
                    F.round("psi", 4).alias("psi"),
                    F.round("ks_statistic", 4).alias("ks_stat"),
                    F.round("ks_p_value", 4).alias("p_value"),
                    "is_drifted",
                    "severity",
                )
            )
        )
    ).scalar()
    report = status.withColumn("scores", entries)
    return report.withColumn("scores", F.transform("scores", lambda e: e.dropFields("position")))


def banded_scores(drift: DataFrame, n: int = 15) -> DataFrame:
    """First n features (by name) with the colour band of their PSI."""
    band = F.when(F.col("psi") >= PSI_THRESHOLD, "red").when(F.col("psi") >= PSI_AMBER, "amber").otherwise("green")
    return drift.select("feature", half_up("psi", 6).alias("psi"), band.alias("band")).orderBy("feature").limit(n)
