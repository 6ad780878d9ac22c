"""The adaptive loop: score a batch of realized weeks, correct biases, log, and replace a weak champion."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scores
from ..functions.numbers import col, half_up
from ..operators.explore import last_history
from ..operators.forecast import FORECAST, Forecaster, score
from ..operators.profiles import KEYS, adaptive_forecast, sku_profiles
from ..session import exists
from ..sources.contracts import FEEDBACK_SCHEMA
from ..sources.staging import stage

WMAPE_LIMIT = 0.25
HELD_OUT = "_held_out_part"
NO_ROWS, ABOVE_LIMIT, FORCED = "no_rows", "wmape_above_limit", "forced"


def feedback_rows(
    df: DataFrame,
    batch_id: int | Column = 0,
    week: str = "week",
    center: str = "center_id",
    meal: str = "meal_id",
    forecast: str = FORECAST,
    actual: str = "actual_orders",
) -> DataFrame:
    """Log records of a scored frame: values, error and error in percent, 2 digits each."""
    for name in (week, center, meal, forecast, actual):
        if name not in df.columns:
            raise KeyError(f"feedback column '{name}' is not in the frame")
    f, a = col(forecast).cast("double"), col(actual).cast("double")
    number = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return df.select(
        number.cast("bigint").alias("batch_id"),
        F.col(week).cast("int").alias("week"),
        F.col(center).cast("bigint").alias("center_id"),
        F.col(meal).cast("int").alias("meal_id"),
        half_up(f, 2).alias("forecast_orders"),
        half_up(a, 2).alias("actual_orders"),
        half_up(a - f, 2).alias("error"),
        half_up((a - f) / F.greatest(F.lit(1.0), a) * 100, 2).alias("percentage_error"),
        F.current_timestamp().alias("recorded_at"),
    )


def partial_sums() -> list[Column]:
    """What a summary needs of log records, in the order of ``SUMS``; sums of several parts add up."""
    error = F.col("error")
    return [
        F.count(F.lit(1)).alias("sample_count"),
        F.count(error).alias("errors"),
        F.sum(error).alias("error_sum"),
        F.count_if(error > 0).cast("bigint").alias("under"),
        F.count_if(error < 0).cast("bigint").alias("over"),
        *scores.error_sums("actual_orders", "forecast_orders"),
    ]


SUMS = (
    "sample_count bigint, errors bigint, error_sum double, under bigint, over bigint, "
    "pairs bigint, abs_error double, sq_error double, sq_log_error double, abs_actual double"
)
SUM_COLUMNS = [part.strip().split(" ")[0] for part in SUMS.split(",")]


def summary_of_sums(parts: DataFrame) -> DataFrame:
    """Count, measures, mean bias and share of under- and over-forecasts in one row, from rows of ``SUMS``."""
    sums = parts.agg(*[F.sum(name).alias(name) for name in SUM_COLUMNS])
    sums = sums.withColumn("sample_count", F.coalesce("sample_count", F.lit(0).cast("bigint")))
    measures = scores.from_sums()
    empty = F.col("sample_count") == 0
    n = F.nullif(F.col("errors"), F.lit(0))

    def shown(c: Column) -> Column:
        return F.when(~empty, c)

    return sums.select(
        F.when(empty, "EMPTY").otherwise("ACTIVE").alias("status"),
        "sample_count",
        *[shown(measures[m]).alias(m) for m in ("wmape", "rmsle", "mae", "rmse")],
        shown(half_up(F.col("error_sum") / n, 2)).alias("mean_bias_units"),
        shown(half_up(F.col("under") / n * 100, 2)).alias("under_forecast_rate_pct"),
        shown(half_up(F.col("over") / n * 100, 2)).alias("over_forecast_rate_pct"),
    )


def feedback_summary(log: DataFrame) -> DataFrame:
    """``summary_of_sums`` of log records."""
    return summary_of_sums(log.agg(*partial_sums()))


class FeedbackLog:
    """Append-only log of realized weeks: a Parquet table with one folder per batch.

    Writing a batch again replaces its folder, so a repeated batch leaves no duplicates. All records count
    unless the caller asks for the newest ``max_history`` only.

    The sums of each batch are taken while its records are written and kept beside the log, one row per batch
    number, so a summary adds up these rows and reads no records. A batch counts in it from the moment its sums are
    written, which is after its records; a batch that was stopped in between is put right when it is repeated.
    """

    def __init__(self, spark: SparkSession, folder: str, max_history: int | None = None) -> None:
        if max_history is not None and max_history <= 0:
            raise ValueError(f"max_history must be positive, got {max_history}")
        self.spark, self.folder, self.max_history = spark, folder, max_history
        self.sums_folder = f"{folder.rstrip('/')}-sums"

    def _written(self, folder: str, schema: str) -> DataFrame | None:
        if not exists(self.spark, folder):
            return None
        found = self.spark.read.schema(schema).parquet(folder)
        return found.select(*[part.strip().split(" ")[0] for part in schema.split(",")])

    def record(self, scored: DataFrame, batch_id: int, **columns) -> None:
        if self._written(self.sums_folder, SUMS) is None and self._written(self.folder, FEEDBACK_SCHEMA) is not None:
            self.rebuild_sums()
        seen = Observation()
        rows = feedback_rows(scored, batch_id, **columns).observe(seen, *partial_sums())
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(
            self.folder
        )
        got = seen.get
        if got["sample_count"]:  # no rows replace nothing in the log either
            kinds = dict(part.strip().split(" ") for part in SUMS.split(","))
            one = self.spark.range(0, 1, 1, 1).select(*[F.lit(got[name]).cast(kinds[name]).alias(name) for name in SUM_COLUMNS])
            one.write.mode("overwrite").parquet(f"{self.sums_folder}/batch_id={batch_id}")

    def rebuild_sums(self) -> None:
        """Work out the sums of all batches from the log, for one that was written without them."""
        sums = self.everything().groupBy("batch_id").agg(*partial_sums())
        sums.write.mode("overwrite").partitionBy("batch_id").parquet(self.sums_folder)

    def sums(self) -> DataFrame:
        """(batch_id, ``SUMS``), one row per batch."""
        found = self._written(self.sums_folder, f"batch_id bigint, {SUMS}")
        return self.everything().groupBy("batch_id").agg(*partial_sums()) if found is None else found

    def everything(self) -> DataFrame:
        found = self._written(self.folder, FEEDBACK_SCHEMA)
        return self.spark.createDataFrame([], FEEDBACK_SCHEMA) if found is None else found

    def _crossing(self) -> tuple[int, int] | None:
        """The batch in which the newest ``max_history`` rows run out and how many of them it holds."""
        # One row per batch; one of them comes back.
        upto = F.sum("sample_count").over(Window.orderBy(F.col("batch_id").desc()))
        sizes = self.sums().select("batch_id", "sample_count").withColumn("upto", upto)
        edge = F.max(F.struct("batch_id", "sample_count", "upto")).alias("edge")
        row = sizes.filter(F.col("upto") > self.max_history).agg(edge).first()["edge"]
        return None if row is None else (row["batch_id"], self.max_history - (row["upto"] - row["sample_count"]))

    def _edge(self, batch_id: int, room: int) -> DataFrame:
        return last_history(self.everything().filter(F.col("batch_id") == batch_id), room)

    def read(self) -> DataFrame:
        """All records, or the newest ``max_history`` if that was asked for.

        Whole batches are kept from the newest on; only the one that crosses the limit is ordered, so
        neither older batches are read nor the kept ones sorted.
        """
        log = self.everything()
        crossing = None if self.max_history is None else self._crossing()
        if crossing is None:
            return log
        batch_id, room = crossing
        kept = log.filter(F.col("batch_id") > batch_id)
        return kept.unionByName(self._edge(batch_id, room)) if room else kept

    def summary(self) -> DataFrame:
        """The summary of ``read()``, from the sums of the batches; only a batch cut by the limit is read."""
        sums = self.sums()
        crossing = None if self.max_history is None else self._crossing()
        if crossing is not None:
            batch_id, room = crossing
            sums = sums.filter(F.col("batch_id") > batch_id)
            if room:
                sums = sums.drop("batch_id").unionByName(self._edge(batch_id, room).agg(*partial_sums()))
        return summary_of_sums(sums)


@dataclass
class LoopResult:
    champion_wmape: float = 0.0
    adaptive_wmape: float = 0.0
    challenger_wmape: float | None = None
    promoted: bool = False
    improvement_pct: float = 0.0
    retrain: bool = False
    reasons: list[str] = field(default_factory=list)


def improvement_pct(champion: Column, adaptive: Column) -> Column:
    return half_up(F.when(champion > 0, (champion - adaptive) / champion * 100).otherwise(0.0), 2)


def correct_batch(
    batch: DataFrame, champion: Forecaster, actual: str = "num_orders", rate: float = 0.65
) -> tuple[DataFrame, DataFrame]:
    """(batch with champion and adaptive forecasts, profiles fitted on the batch).

    The profiles come from the batch they correct, so the gain is measured in sample.
    """
    scored = stage(champion.transform(batch), "scored")
    profiles = stage(sku_profiles(scored, actual=actual), "profiles")
    return adaptive_forecast(scored, profiles, rate), profiles


def held_out_correction(
    batch: DataFrame,
    champion: Forecaster,
    parts: int = 3,
    part_weeks: int = 4,
    actual: str = "num_orders",
    rate: float = 0.65,
    week: str = "week",
) -> DataFrame:
    """The batch with champion and adaptive forecasts, no week corrected by a profile that has seen it.

    Blocks of ``part_weeks`` weeks are dealt in turn to the parts. A row is corrected by its pair's profile over
    the other parts; a pair without rows there, or a row without a week, keeps the champion's forecast. One
    aggregation makes the profiles of all parts, for which each row is copied ``parts - 1`` times.
    """
    if parts < 2 or part_weeks < 1:
        raise ValueError(f"at least 2 parts of at least 1 week are needed, got {parts} of {part_weeks}")
    scored = stage(champion.transform(batch), "scored")
    keys = [HELD_OUT, *KEYS]
    rows = scored.withColumn(HELD_OUT, F.pmod(F.floor((F.col(week) - 1) / part_weeks), F.lit(parts)).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: p != F.col(HELD_OUT))
    profiles = stage(sku_profiles(rows.withColumn(HELD_OUT, F.explode(others)), actual=actual, keys=keys), "profiles")
    return adaptive_forecast(rows, profiles, rate, keys=keys).drop(HELD_OUT)


def batch_scores(corrected: DataFrame, actual: str = "num_orders") -> DataFrame:
    """One row: champion and adaptive WMAPE and the improvement in percent, from one pass."""
    both = F.array(
        F.struct(F.lit("champion").alias("who"), col(FORECAST).cast("double").alias("value")),
        F.struct(F.lit("adaptive").alias("who"), F.col("adaptive_orders").cast("double").alias("value")),
    )
    scored = score(corrected.select(actual, F.inline(both)), actual, "value", by=["who"])
    row = scored.agg(
        F.max(F.when(F.col("who") == "champion", F.col("wmape"))).alias("champion_wmape"),
        F.max(F.when(F.col("who") == "adaptive", F.col("wmape"))).alias("adaptive_wmape"),
    )
    return row.withColumn("improvement_pct", improvement_pct(F.col("champion_wmape"), F.col("adaptive_wmape")))


WHO = {"champion": FORECAST, "adaptive": "adaptive_orders"}


def both_sums(actual: str = "num_orders") -> list[Column]:
    """The sums behind the measures of champion and corrected forecasts, to be observed while a batch is written."""
    return [c.alias(f"{who}_{n}") for who, p in WHO.items() for n, c in zip(scores.SUM_NAMES, scores.error_sums(actual, p))]


def observed_scores(spark: SparkSession, sums: dict[str, float | None]) -> DataFrame:
    """The row of ``batch_scores`` from observed ``both_sums``."""
    kind = {name: "bigint" if name == "pairs" else "double" for name in scores.SUM_NAMES}
    row = spark.range(1).select("id")
    for who in WHO:
        found = [F.lit(sums[f"{who}_{name}"]).cast(kind[name]).alias(name) for name in scores.SUM_NAMES]
        row = row.withColumns(dict(zip(scores.SUM_NAMES, found))).withColumn(f"{who}_wmape", scores.from_sums()["wmape"])
    improved = improvement_pct(F.col("champion_wmape"), F.col("adaptive_wmape")).alias("improvement_pct")
    return row.select(*[f"{who}_wmape" for who in WHO], improved)


class ChampionShelf:
    """Champions by the number of the batch that promoted them: one folder each, written by Spark.

    For forecasters with ``save(folder)`` and ``load(spark, folder)``.
    """

    def __init__(self, spark: SparkSession, folder: str, kind: type) -> None:
        self.spark, self.folder, self.kind = spark, folder, kind

    def _versions(self) -> DataFrame:
        return self.spark.read.schema("batch_id bigint, saved string").json(f"{self.folder}/versions")

    def put(self, champion: Forecaster, number: int) -> None:
        """The version is listed once its model is complete; putting it again replaces it."""
        saved = f"{self.folder}/champion-{number}"
        champion.save(saved)
        row = self.spark.createDataFrame([(number, saved)], "batch_id bigint, saved string")
        row.coalesce(1).write.mode("overwrite").json(f"{self.folder}/versions/v={number}")

    def before(self, number: int) -> Forecaster | None:
        """The newest champion of the batches before ``number``."""
        try:
            last = self._versions().filter(F.col("batch_id") < number).agg(F.max_by("saved", "batch_id")).first()[0]
        except AnalysisException as err:
            if "PATH_NOT_FOUND" not in str(err.getCondition()):
                raise
            return None
        return self.kind.load(self.spark, last) if last else None


def newest_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """The profiles of the last batch, from the table that the loop writes."""
    written = spark.read.parquet(folder)
    last = written.select("batch_id").agg(F.max("batch_id")).scalar()
    return written.filter(F.col("batch_id") == last).drop("batch_id")


class AdaptiveLoop:
    """Runs one batch after the other.

    ``profiles_folder`` holds one folder per batch, of which ``newest_profiles`` reads the last one. With a
    ``shelf`` a promoted champion is saved there under its batch number, and a new loop starts from the newest
    one of the batches before its own; so a repeated batch meets the champion that it met the first time.
    The seed of a challenger is the batch number.
    """

    def __init__(
        self,
        champion: Forecaster,
        log: FeedbackLog,
        rate: float = 0.65,
        challenger: Callable[[int], Forecaster] | None = None,
        profiles_folder: str | None = None,
        on_promotion: Callable[[Forecaster, int], None] | None = None,
        shelf: ChampionShelf | None = None,
    ) -> None:
        self.champion, self.log, self.rate = champion, log, rate
        self.challenger, self.profiles_folder, self.on_promotion = challenger, profiles_folder, on_promotion
        self.shelf, self.first_champion = shelf, champion
        self.profiles: DataFrame | None = None
        self.iteration = 0

    def process(
        self, batch: DataFrame, actual: str = "num_orders", force_retrain: bool = False, batch_id: int | None = None
    ) -> LoopResult:
        if batch.isEmpty():
            return LoopResult(reasons=[NO_ROWS])
        self.iteration += 1
        number = self.iteration if batch_id is None else batch_id
        if actual not in batch.columns and "actual_orders" in batch.columns:
            actual = "actual_orders"
        if self.shelf is not None:
            self.champion = self.shelf.before(number) or self.first_champion
        corrected, self.profiles = correct_batch(batch, self.champion, actual, self.rate)
        if self.profiles_folder:
            self.profiles.write.mode("overwrite").parquet(f"{self.profiles_folder}/batch_id={number}")
        # The batch is scored while it is logged: its profiles are looked up once for both.
        seen = Observation()
        realized = corrected.observe(seen, *both_sums(actual)).withColumn(FORECAST, F.col("adaptive_orders"))
        self.log.record(realized.withColumn("actual_orders", F.col(actual).cast("double")), number)
        row = observed_scores(self.log.spark, seen.get).first()
        result = LoopResult(row.champion_wmape, row.adaptive_wmape, improvement_pct=row.improvement_pct)

        if result.champion_wmape > WMAPE_LIMIT:
            result.reasons.append(ABOVE_LIMIT)
        if force_retrain:
            result.reasons.append(FORCED)
        result.retrain = bool(result.reasons)
        if result.retrain and self.challenger is not None:
            rival = self.challenger(number).fit(batch)
            result.challenger_wmape = score(rival.transform(batch), actual).first().wmape
            if result.challenger_wmape < result.champion_wmape:
                self.champion, result.promoted = rival, True
                if self.shelf is not None:
                    self.shelf.put(rival, number)
                if self.on_promotion:
                    self.on_promotion(rival, number)
        return result
