"""Quality rules: robust multivariate outliers of text statistics, with DataFrame functions only.

Every document has a vector of transformed statistics. For each group of documents (language and source) the
minimum-covariance-determinant estimate gives a centre and a scatter matrix that outliers do not move: from two
starts, the rows nearest the median and those nearest the mean, concentration steps keep the share of rows with
the smallest Mahalanobis distances and estimate again from them; of the two results the one with the smaller
determinant counts. Rows far beyond what the scatter allows are rejected.

All steps are aggregations by group over a written table of the narrow vectors, combined before the shuffle;
the share is cut at an approximate quantile, so no group is sorted or gathered.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import documents, stage

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
VECTOR = ("word_length", "symbols", "dup_lines", "repeats", "size")
GROUP = ("_lang", "_source")


@dataclass(frozen=True)
class McdSpec:
    share: float = 0.75  # of a group's rows that its estimate rests on
    # What the covariance of the central share falls short of that of all rows of a normal distribution in five
    # dimensions, share / P(chi-square_7 <= the share's quantile of chi-square_5); belongs to the share above.
    consistency: float = 1.412
    steps: int = 8  # concentration steps at most; they end when no determinant falls by more than ``settled``
    settled: float = 0.01
    least_rows: int = 200  # groups with fewer rows are pooled by language, too small pools judged by all rows
    # Squared distance beyond which a row is rejected: for five dimensions chi-square exceeds it once in 10^8
    # rows. Clean statistics have longer tails than the normal distribution; this leaves room for them.
    cutoff: float = 46.0
    # Smallest standard deviation of each transformed statistic that counts; below it differences mean nothing.
    floors: tuple[float, ...] = (0.06, 0.06, 0.08, 0.10, 1.0)
    accuracy: int = 1000  # of the approximate quantiles


def _let(value: Column, use) -> Column:
    """Computes ``value`` once for all its uses in ``use``."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words that lie in windows of eight words found twice or more in the text, the first find included."""

    def hashes(ws: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(ws) - WINDOW + 1)
        return F.transform(starts, lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))

    def covered(ws: Column) -> Column:
        # Two hashes of each window and its place, in order of the hashes; then the places of those with an equal
        # neighbour, and the words from each place up to the next.
        keyed = F.transform(
            F.sequence(F.lit(1), F.size(ws) - WINDOW + 1),
            lambda i: F.struct(
                F.xxhash64(F.slice(ws, i, WINDOW)).alias("h"), F.xxhash64(F.lit(1), F.slice(ws, i, WINDOW)).alias("g"), i.alias("i")
            ),
        )

        def equal(a: Column, b: Column) -> Column:
            return (a["h"] == b["h"]) & (a["g"] == b["g"])

        def twice(s: Column) -> Column:
            n = F.size(s)
            return F.filter(
                s,
                lambda x, k: ((k > 0) & equal(x, F.get(s, k - 1))) | ((k < n - 1) & equal(x, F.get(s, k + 1))),
            )

        def words_in(places: Column) -> Column:
            spans = F.transform(places, lambda p, k: F.coalesce(F.least(F.lit(WINDOW), F.get(places, k + 1) - p), F.lit(WINDOW)))
            return F.aggregate(spans, F.lit(0), lambda a, b: a + b)

        found = _let(F.sort_array(keyed), twice)
        return _let(F.sort_array(F.transform(found, lambda x: x["i"])), words_in)

    def count(ws: Column) -> Column:
        # Most texts repeat no window: equal numbers of hashes and distinct hashes prove it.
        again = _let(hashes(ws), lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(F.size(ws) < WINDOW + 1, 0).when(again, covered(ws)).otherwise(0)

    return _let(words, count).cast("long")


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *kept: str) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` and the ``kept`` columns.

    Words are ``[^\\x20\\x09-\\x0D]+``; a null text has none. ``base_failed``: fewer than 20 words, or over 30 in
    100 words in windows that occur again.
    """
    text = F.col("text")
    words = F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, " " + BLANKS, "")) > 0)
    counted = documents(docs, id_col, text_col, **{c: c for c in kept}).select(
        "doc_id",
        *kept,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(text, " " + BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        _repeat_words(words).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def vector(rows: DataFrame) -> list[Column]:
    """The transformed statistics: logarithms and square roots that make clean texts of one group alike."""
    n = F.greatest("n_words", F.lit(1))
    return [
        F.log((F.col("word_chars") + 5) / (n + 1)),
        F.sqrt(F.col("n_symbols") / n),
        F.sqrt(F.col("n_dup_lines") / n),
        F.sqrt(F.col("n_repeat_words") / n),
        F.log1p(n.cast("double")),
    ]


KEYS = ("_level", *GROUP)  # level 0: language and source, 1: language (source null), 2: all rows (both null)


def _same_group(left: str, right: str, keys: tuple[str, ...] = KEYS) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in keys])


def _factor(estimates: DataFrame, spec: McdSpec) -> DataFrame:
    """Adds the Cholesky factor ``l_i_j`` of the covariance ``c_i_j`` with the floors on its diagonal."""
    size = len(VECTOR)
    out = estimates
    for i in range(size):
        for j in range(i + 1):
            value = F.col(f"c_{i}_{j}")
            if i == j:
                value = value + F.lit(spec.floors[i] ** 2)
            for k in range(j):
                value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            # What is left on the diagonal is never below the floor but for rounding.
            value = F.sqrt(F.greatest(value, F.lit(spec.floors[i] ** 2 / 4))) if i == j else value / F.col(f"l_{j}_{j}")
            out = out.withColumn(f"l_{i}_{j}", value)
    return out


def _with_distances(rows: DataFrame, estimates: DataFrame, spec: McdSpec, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Adds the squared Mahalanobis distance ``_d``, null for a group without an estimate."""
    size = len(VECTOR)
    joined = rows.alias("r").join(_factor(estimates, spec).alias("e"), _same_group("r", "e", keys), "left")
    joined = joined.select("r.*", *[f"e.m_{i}" for i in range(size)], *[f"e.l_{i}_{j}" for i in range(size) for j in range(i + 1)])
    for i in range(size):  # solves l y = x - m
        rest = F.col(f"x_{i}") - F.col(f"m_{i}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        joined = joined.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
    total = reduce(add, [F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(size)])
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], total.alias("_d"))


def _moments(rows: DataFrame, start: Column) -> DataFrame:
    """Mean and covariance of the vectors of each group, by start."""
    size = len(VECTOR)
    x = [F.col(f"x_{i}") for i in range(size)]
    return rows.groupBy(*KEYS, start.alias("_start")).agg(
        *[F.avg(x[i]).alias(f"m_{i}") for i in range(size)],
        *[F.covar_pop(x[i], x[j]).alias(f"c_{i}_{j}") for i in range(size) for j in range(i + 1)],
    )


def _medians(rows: DataFrame, spec: McdSpec) -> DataFrame:
    """Median and squared median deviation of each statistic: a diagonal estimate, start 0."""
    size = len(VECTOR)
    middle = rows.groupBy(*KEYS).agg(*[F.percentile_approx(f"x_{i}", 0.5, spec.accuracy).alias(f"m_{i}") for i in range(size)])
    near = rows.alias("r").join(middle.alias("m"), _same_group("r", "m"))
    away = near.select("r.*", *[F.abs(F.col(f"r.x_{i}") - F.col(f"m.m_{i}")).alias(f"a_{i}") for i in range(size)])
    spread = away.groupBy(*KEYS).agg(
        *[(1.4826 * F.percentile_approx(f"a_{i}", 0.5, spec.accuracy)).alias(f"s_{i}") for i in range(size)]
    )
    both = middle.alias("m").join(spread.alias("s"), _same_group("m", "s"))
    zero = F.lit(0.0)
    return both.select(
        *[f"m.{c}" for c in KEYS],
        F.lit(0).alias("_start"),
        *[f"m.m_{i}" for i in range(size)],
        *[(F.col(f"s.s_{i}") * F.col(f"s.s_{i}") if i == j else zero).alias(f"c_{i}_{j}") for i in range(size) for j in range(i + 1)],
    )


def _log_determinant(estimates: DataFrame, spec: McdSpec) -> DataFrame:
    found = _factor(estimates, spec)
    return found.select(*estimates.columns, (2 * reduce(add, [F.log(f"l_{i}_{i}") for i in range(len(VECTOR))])).alias("_det"))


def minimum_covariance(rows: DataFrame, spec: McdSpec) -> DataFrame:
    """The estimate ``m_i, c_i_j`` of each group of the written ``rows(_level, _lang, _source, x_i)``.

    Steps from both starts go on side by side, so that each pass over the rows serves both.
    """
    by_start = (*KEYS, "_start")
    starts = _medians(rows, spec).unionByName(_moments(rows, F.lit(1)))
    estimates = stage(_log_determinant(starts, spec), "estimate")
    each = rows.withColumn("_start", F.explode(F.array(F.lit(0), F.lit(1))))
    for step in range(spec.steps):
        near = _with_distances(each, estimates, spec, by_start)
        cut = near.groupBy(*by_start).agg(F.percentile_approx("_d", spec.share, spec.accuracy).alias("_cut"))
        inside = near.alias("r").join(cut.alias("c"), _same_group("r", "c", by_start)).filter("r._d <= c._cut").select("r.*")
        after = stage(_log_determinant(_moments(inside, F.col("_start")), spec), "estimate")
        both = after.alias("a").join(estimates.alias("b"), _same_group("a", "b", by_start))
        fall = both.agg(F.max(F.col("b._det") - F.col("a._det"))).first()[0]
        estimates = after
        if step and (fall is None or fall <= spec.settled):
            break
    numbers = [c for c in estimates.columns if c[:2] in ("m_", "c_")]
    best = estimates.groupBy(*KEYS).agg(F.min_by(F.struct(*numbers), F.struct("_det", "_start")).alias("e"))
    wider = [(F.col(f"e.{c}") * spec.consistency if c[0] == "c" else F.col(f"e.{c}")).alias(c) for c in numbers]
    return stage(best.select(*KEYS, *wider), "estimate")


def _groups(rows: DataFrame, spec: McdSpec) -> DataFrame:
    """``_lang, _source, _level``: how each language and source is judged."""
    sizes = stage(rows.groupBy(*GROUP).agg(F.count_if(~F.col("base_failed")).alias("_n")), "sizes")
    small = sizes.filter(F.col("_n") < spec.least_rows).groupBy("_lang").agg(F.sum("_n").alias("_pool"))
    pooled = sizes.alias("s").join(small.alias("p"), F.col("s._lang").eqNullSafe(F.col("p._lang")), "left")
    level = F.when(F.col("_n") >= spec.least_rows, 0).when(F.col("_pool") >= spec.least_rows, 1).otherwise(2)
    return stage(pooled.select("s._lang", "s._source", level.alias("_level")), "groups")


def robust_outliers(
    docs: DataFrame,
    spec: McdSpec = McdSpec(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Base counts of every row, ``distance`` (squared, null if no row passes the base rules) and ``kept``.

    ``kept`` is false if ``base_failed`` or the distance exceeds the cutoff. Null languages and sources are
    groups like others. Groups with few rows are pooled with the other small ones of their language; where that
    is still too few, rows are judged by an estimate over all rows of the table. Rows that fail the base rules
    take no part in the estimates. Every row is judged by itself: repeated ones alike, null and empty texts fail.
    """
    return _judged(docs, spec, id_col, text_col, lang_col, source_col, []).withColumnRenamed("_kept", "kept")


def kept_rows(
    docs: DataFrame, spec: McdSpec = McdSpec(), text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """The rows of ``docs`` that ``robust_outliers`` keeps, with all their columns.

    The table is written once beside its statistics, and the decision is made where the rows are: none is moved.
    """
    carried = docs.columns
    judged = _judged(docs, spec, None, text_col, lang_col, source_col, carried)
    return judged.filter("_kept").select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)])


def _judged(
    docs: DataFrame, spec: McdSpec, id_col: str | None, text_col: str, lang_col: str, source_col: str, carried: list[str]
) -> DataFrame:
    held = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carried)]
    ids = F.col(id_col) if id_col else F.lit(None).cast("long")
    named = docs.select(
        ids.alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"), *held
    )
    kept = [f"_c{i}" for i in range(len(carried))]
    counted = base_counts(named, "doc_id", "text", *GROUP, *kept)
    columns = [c for c in counted.columns if c not in GROUP]
    x = [f"x_{i}" for i in range(len(VECTOR))]
    rows = stage(counted.select("*", *[v.alias(name) for v, name in zip(vector(counted), x, strict=True)]), "statistics")

    groups = _groups(rows, spec)

    def levelled(frame: DataFrame) -> DataFrame:
        level = F.col("g._level")
        grouped = [level, F.when(level < 2, F.col("r._lang")).alias("_lang"), F.when(level < 1, F.col("r._source")).alias("_source")]
        others = [F.col(f"r.{c}") for c in frame.columns if c not in GROUP]
        return frame.alias("r").join(groups.alias("g"), _same_group("r", "g", GROUP)).select(*grouped, *others)

    usable = rows.filter(~F.col("base_failed")).select(*GROUP, *x)
    grouped = levelled(usable).filter("_level < 2")
    if not groups.filter("_level = 2").isEmpty():
        nothing = [F.lit(None).cast(usable.schema[c].dataType).alias(c) for c in GROUP]
        grouped = grouped.unionByName(usable.select(F.lit(2).alias("_level"), *nothing, *x))
    estimates = minimum_covariance(stage(grouped, "grouped"), spec)
    judged = _with_distances(levelled(rows), estimates, spec).withColumnRenamed("_d", "distance")
    verdict = ~F.col("base_failed") & F.coalesce(F.col("distance") <= spec.cutoff, F.lit(False))
    return judged.select(*columns, "distance", verdict.alias("_kept"))
