"""Ordered work inside groups of which one may hold a third of all rows.

Lags, quantiles and cumulative shares need the order of the rows of a group. A plain window or
``percentile`` puts a whole group into one task. The functions here find the groups that are too large
for that, cut them at approximate quantiles of the order key into pieces that keep the order, work on
the pieces in parallel and put the exact result together.

A group is cut if it has more than ``LIGHT_ROWS`` rows, the most that one task orders, into as many pieces as
that takes (``PIECES`` at most). So there is at most one heavy group for each ``LIGHT_ROWS`` rows of the data, and
two split points for each: a millionth of the rows in numbers, which is what is broadcast about them.

A sketch depends on the order in which its parts arrive, so the same split points worked out twice may differ. They are
therefore worked out once: written if a plan needs them in two places, else carried along as the bounds of each piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage

PIECES = 2048
LIGHT_ROWS = 1_000_000
ACCURACY = 10_000
SLOTS = 65_536  # hashes of group keys that rows are counted by
SPREAD = 10_000  # parts that rows without a key are dealt into


def _all_set(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def heavy_groups(
    df: DataFrame,
    keys: Sequence[str],
    light_rows: int = LIGHT_ROWS,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Groups with more than ``light_rows`` rows: at most one for each ``light_rows`` rows.

    Rows are counted by a hash of their key first, a few numbers for each task. Only groups whose hash has more than
    ``light_rows`` rows are counted by themselves; without one, adaptive execution removes that part.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).cast("int").alias("_slot")
    full = df.groupBy(slot).agg(F.count(F.lit(1)).alias("slot_rows")).filter(F.col("slot_rows") > light_rows).select("_slot")
    near = df.select("*", slot).join(F.broadcast(full), "_slot")
    sizes = near.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"), *extra)
    return sizes.filter(F.col("group_rows") > light_rows)


def _probabilities(pieces: int) -> list[float]:
    return [i / pieces for i in range(1, pieces)]


STRIDE = 16


def _splits(
    df: DataFrame, keys: Sequence[str], value: Column, light_rows: int, pieces: int | None, *extra: Column
) -> DataFrame:
    """Per group: increasing split points of ``value``, and every 16th of them.

    There are ``pieces`` of them, or as many as make pieces of half ``light_rows`` rows. The sketch merges on
    the map side.
    """
    most = pieces or PIECES
    wanted = F.lit(most) if pieces else F.least(F.lit(most), F.ceil(2 * F.count(F.lit(1)) / F.lit(light_rows)))
    step = F.greatest(F.lit(1), F.floor(F.lit(most) / wanted))
    found = df.groupBy(*keys).agg(
        F.percentile_approx(value, _probabilities(most), ACCURACY).alias("points"), step.alias("step"), *extra
    )
    chosen = F.filter("points", lambda p, i: (i + 1) % F.col("step") == 0)
    found = found.withColumn("fine", F.array_sort(F.array_distinct(chosen))).drop("points", "step")
    coarse = F.filter("fine", lambda s, i: i % STRIDE == STRIDE - 1)
    return found.withColumn("splits", F.struct(coarse.alias("coarse"), F.col("fine"))).drop("fine")


def _piece(value: Column) -> Column:
    """Number of split points below the value: non-decreasing in the value, 0 without splits.

    Compares with every 16th split first and then only with those between two of them.
    """
    start = F.size(F.filter("splits.coarse", lambda s: s < value)) * STRIDE
    near = F.filter(F.slice("splits.fine", start + 1, F.lit(STRIDE)), lambda s: s < value)
    # Never null, so that a join on it needs no null check that would work it out once more.
    return F.coalesce(start + F.size(near), F.lit(0))


def cut_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    reach: int,
    carried: Sequence[str],
    light_rows: int = LIGHT_ROWS,
    pieces: int | None = None,
) -> DataFrame:
    """Cut long series into pieces that can be windowed on their own.

    Adds ``piece`` and ``halo``. Every piece after the first is preceded by copies (``halo`` true) of the
    last ``reach`` rows before it, holding the keys, the order columns and ``carried``; a window over
    (keys, piece) that looks back at most ``reach`` rows is then exact. Drop the halo rows afterwards.
    """
    first = order[0]
    tie = order[1] if len(order) > 1 else None
    bounds = [F.min(tie).alias("tie_low"), F.max(tie).alias("tie_high")] if tie else []
    heavy = heavy_groups(df.filter(_all_set(keys)), keys, light_rows, bounds)

    # A double that never decreases along (first, tie); equal values only end up in the same piece.
    position = F.col(first).cast("double")
    if tie:
        span = F.col("tie_high").cast("double") - F.col("tie_low").cast("double") + 1.0
        position = position + (F.col(tie).cast("double") - F.col("tie_low").cast("double")) / span
    kept = [F.first(c).alias(c) for c in ("tie_low", "tie_high")] if tie else []
    splits = _splits(
        df.select(*keys, *order).join(F.broadcast(heavy), list(keys)), keys, position, light_rows, pieces, *kept
    )
    splits = stage(splits, "splits")
    tagged = df.join(F.broadcast(splits), list(keys), "left").withColumn("piece", _piece(position))

    # The last rows of each piece: row_number <= reach is limited per task before it is shuffled.
    ends = Window.partitionBy(*keys, "piece").orderBy(*[F.col(c).desc() for c in order])
    tails = (
        tagged.filter("splits IS NOT NULL")
        .select(*keys, "piece", *order, *[c for c in carried if c not in order])
        .withColumn("from_end", F.row_number().over(ends))
        .filter(F.col("from_end") <= reach)
    )
    row = F.struct(*order, *[c for c in carried if c not in order])
    tails = tails.groupBy(*keys, "piece").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    # A piece may hold fewer than `reach` rows, so look back over `reach` pieces (PIECES at most exist).
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(-reach, -1)
    halo = (
        tails.withColumn("rows", F.flatten(F.collect_list("rows").over(before)))
        .withColumn("rows", F.expr(f"slice(rows, greatest(size(rows) - {reach} + 1, 1), {reach})"))
        .select(*keys, "piece", F.inline("rows"))
        .withColumn("halo", F.lit(True))
    )
    tagged = tagged.drop("splits", "tie_low", "tie_high").withColumn("halo", F.lit(False))
    return tagged.unionByName(halo, allowMissingColumns=True)


def value_counts(df: DataFrame, keys: Sequence[str], value: str | Column) -> DataFrame:
    """(keys, value, weight): how often each value occurs; missing values and keys are left out.

    The shuffle key includes the value, so a hot group spreads over its values and a hot value is
    one row per task.
    """
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.filter(_all_set(keys)).select(*keys, value.alias("value"))
    return (
        rows.filter("value IS NOT NULL AND NOT isnan(value)")
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def _between(low: Column, high: Column, part: Column) -> Column:
    """Linear interpolation that meets both ends exactly."""
    return F.when(part < 0.5, low + (high - low) * part).otherwise(high - (high - low) * (1 - part))


def _pick(ranked: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(keys, quantiles) from rows with ``value``, ``upto`` (rows up to the value) and ``n`` (rows in all).

    The value at 0-based position k is the smallest one with more than k rows up to it.
    """
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in probabilities]
    ends = [F.min(F.when(F.col("upto") > edge(k), F.col("value"))) for k in place for edge in (F.floor, F.ceil)]
    found = ranked.groupBy(*keys).agg(F.first("n").alias("n"), *[e.alias(f"k{i}") for i, e in enumerate(ends)])
    parts = [_between(F.col(f"k{2 * i}"), F.col(f"k{2 * i + 1}"), k - F.floor(k)) for i, k in enumerate(place)]
    return found.select(*keys, F.array(*parts).alias("quantiles"))


def exact_quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    probabilities: Sequence[float],
    weight: str = "weight",
    light_rows: int = LIGHT_ROWS,
    pieces: int | None = None,
) -> DataFrame:
    """(keys, quantiles): exact quantiles with linear interpolation, from ``value_counts`` rows.

    Groups with few distinct values are ordered as a whole. For the others the piece that holds each
    wanted position is found from piece totals, and only those pieces are ordered.
    """
    counts = counts.filter(F.col(weight) > 0).select(*keys, "value", F.col(weight).alias("weight"))
    names = list(keys) or ["all_rows"]
    if not keys:
        counts = counts.withColumn("all_rows", F.lit(1))
    heavy = heavy_groups(counts, names, light_rows, [F.sum("weight").alias("n")])

    ordered = Window.partitionBy(*names).orderBy("value")
    upwards = ordered.rowsBetween(Window.unboundedPreceding, 0)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    light = counts.join(F.broadcast(heavy), names, "left_anti")
    # One order for both, so one pass over the rows of a group gives the running total and the whole one.
    light = light.select("*", F.sum("weight").over(upwards).alias("upto"), F.sum("weight").over(whole).alias("n"))

    # First pass over the heavy groups: rows per piece, a few numbers for each.
    splits = _splits(counts.join(F.broadcast(heavy.select(*names, "n")), names), names, F.col("value"), light_rows, pieces, F.first("n").alias("n"))
    totals = (
        counts.join(F.broadcast(splits), names)
        .withColumn("piece", _piece(F.col("value")))
        .groupBy(*names, "piece")
        .agg(
            F.sum("weight").alias("inside"),
            F.first("n").alias("n"),
            F.first(F.get("splits.fine", F.col("piece") - 1)).alias("above_split"),
            F.first(F.get("splits.fine", F.col("piece"))).alias("upto_split"),
        )
    )
    below = F.sum("inside").over(Window.partitionBy(*names).orderBy("piece")) - F.col("inside")
    totals = totals.withColumn("below", below)
    holds = F.lit(False)
    for p in probabilities:
        for edge in (F.floor, F.ceil):
            k = edge(F.lit(float(p)) * (F.col("n") - 1))
            holds = holds | ((k >= F.col("below")) & (k < F.col("below") + F.col("inside")))
    # Second pass: only the values between the split points around a wanted piece.
    wanted = totals.filter(holds).select(*names, "n", "piece", "below", "above_split", "upto_split")
    here = (F.col("above_split").isNull() | (F.col("value") > F.col("above_split"))) & (
        F.col("upto_split").isNull() | (F.col("value") <= F.col("upto_split"))
    )
    inside = Window.partitionBy(*names, "piece").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    near = (
        counts.join(F.broadcast(wanted), names)
        .filter(here)
        .withColumn("upto", F.col("below") + F.sum("weight").over(inside))
    )
    result = _pick(light, names, probabilities).unionByName(_pick(near, names, probabilities))
    return result if keys else result.drop("all_rows")


def cumulate(
    counts: DataFrame, key: str, weights: Sequence[str], pieces: int | None = None, light_rows: int = LIGHT_ROWS
) -> DataFrame:
    """Running totals of ``weights`` over increasing ``value`` inside each ``key``.

    For keys of which there are few by definition (one per feature or column), so that split points and
    piece totals can be broadcast; the number of values per key is not limited. ``counts`` must hold
    each (key, value) once. Adds ``upto_<weight>``.
    """
    splits = stage(_splits(counts, [key], F.col("value"), light_rows, pieces), "splits")
    cut = counts.join(F.broadcast(splits), key).withColumn("piece", _piece(F.col("value"))).drop("splits")
    inside = Window.partitionBy(key, "piece").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    # Both uses of these rows share one shuffle by (key, piece).
    local = cut.select(key, "piece", "value", *weights, *[F.sum(w).over(inside).alias(f"local_{w}") for w in weights])
    running = Window.partitionBy(key).orderBy("piece")
    ends = local.groupBy(key, "piece").agg(*[F.max(f"local_{w}").alias(f"in_{w}") for w in weights])
    below = ends.select(
        key, "piece", *[(F.sum(f"in_{w}").over(running) - F.col(f"in_{w}")).alias(f"below_{w}") for w in weights]
    )
    return local.join(F.broadcast(below), [key, "piece"]).select(
        key, "value", *weights, *[(F.col(f"below_{w}") + F.col(f"local_{w}")).alias(f"upto_{w}") for w in weights]
    )


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str | Column, probabilities: Sequence[float], **limits
) -> DataFrame:
    return exact_quantiles(value_counts(df, keys, value), keys, probabilities, **limits)


def group_median(df: DataFrame, keys: Sequence[str], value: str | Column, name: str, **limits) -> DataFrame:
    found = group_quantiles(df, keys, value, [0.5], **limits)
    return found.select(*keys, F.col("quantiles")[0].alias(name))
