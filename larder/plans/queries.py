"""The registered queries: every operator run over the whole test tables.

All of them start from the demand panel that Spark derives from ``lineitem`` and ``part`` (see
``sources.star``). Its default grain has one series per supplier and part type, so it grows with the data.
Series rows are weeks of the calendar there, which is what ``one_row_per_week`` states; the queries
named ``*_long_*`` run the same operators with the cutting of long series and groups switched on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BoostSpec, FeatureSpec, Settings, WeekSplit
from ..functions import pricing, scores, stock
from ..functions.numbers import half_up
from ..operators import drift, explore, features, forecast, inventory, profiles, quality, scenarios, series, slices, split
from ..operators.boosted import BoostedForecaster, TreeAttribution, challenger_spec, driver_attribution as shuffle_features
from ..operators.elastic import ProfileForecaster
from ..operators.forecast import FORECAST, MedianForecaster
from ..operators.linear import LinearForecaster, mean_attribution
from ..operators.heavy import group_median, value_counts, exact_quantiles
from ..session import fresh_folder, tune
from ..operators.sketches import RANK_ERROR, SketchTable
from ..sources import artifacts, star, tables as table_reader
from ..sources.colocated import SeriesTable
from ..sources.contracts import CONTRACTS
from ..sources.staging import stage
from ..streaming.feedback import FeedbackStream
from . import adaptive, backtest as bt, training

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPLIT = WeekSplit(train_end=300, val_end=330, total=358)
SETTINGS = Settings(split=SPLIT)
KEYS = ["center_id", "meal_id"]
ID = ["week", "center_id", "meal_id"]
HISTORY = [f"num_orders_lag_{n}" for n in FeatureSpec().lags] + [
    f"num_orders_roll_{s}_{k}" for k in FeatureSpec().windows for s in ("mean", "std")
]
WALK = bt.Walk(folds=3, test_weeks=10, min_train_weeks=50)
SMALL_BOOST = BoostSpec(trees=8, depth=4, rate=0.3, row_share=1.0, column_share=1.0, min_rows=3)
PATIENT_BOOST = replace(SMALL_BOOST, trees=12, patience=3)
DRIFT_FEATURES = [
    "checkout_price", "base_price", "discount_amount", "discount_ratio", "price_ratio", "emailer_for_promotion", "homepage_featured",
    "both_promos", "any_promo", "promo_discount_synergy", "week_of_year", "month_proxy", "quarter_proxy", "center_id", "meal_id", "num_orders",
]
ARRIVAL_WEEKS = 7


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return run


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the double columns, whose last bits depend on the order of summation."""
    return df.select(*[half_up(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- shared inputs ---------------------------------------------------------------------------------


def panel(spark, d, grain="supplier") -> DataFrame:
    return star.demand_panel(spark, d, grain)


def staged_panel(spark, d, grain="supplier") -> DataFrame:
    """For queries that read the panel more than once."""
    return stage(panel(spark, d, grain), "panel")


def metadata(spark, d, grain="supplier") -> tuple[DataFrame, DataFrame]:
    return stage(star.centers(spark, d, grain), "centers"), stage(star.meals(spark, d), "meals")


def enriched(spark, d, grain="supplier", staged=False) -> DataFrame:
    fact = staged_panel(spark, d, grain) if staged else panel(spark, d, grain)
    return features.enrich(fact, *metadata(spark, d, grain))


def whole_frame(spark, d, grain="supplier", **options) -> tuple[DataFrame, list[str]]:
    """The feature frame of the panel with the metadata, and the names of its features."""
    fact = enriched(spark, d, grain, staged=True)
    frame, names, _ = features.feature_frame(fact, one_row_per_week=True, **options)
    return frame, names


def priced(df: DataFrame) -> DataFrame:
    return features.promo_features(features.price_features(df))


def split_scored(df: DataFrame) -> DataFrame:
    """Weeks after the training weeks with the median forecast and the actual demand."""
    fitted = MedianForecaster().fit(df.filter(F.col("week") <= SPLIT.train_end))
    later = df.filter(F.col("week") > SPLIT.train_end)
    return fitted.transform(later).withColumn("actual_orders", F.col("num_orders"))


def test_weeks(df: DataFrame) -> DataFrame:
    return df.filter(F.col("week") > SPLIT.val_end)


def val_weeks(df: DataFrame) -> DataFrame:
    return df.filter((F.col("week") > SPLIT.train_end) & (F.col("week") <= SPLIT.val_end))


def test_plan(spark, d, grain="supplier") -> DataFrame:
    scored = stage(split_scored(staged_panel(spark, d, grain)), "scored")
    std = inventory.residual_rmse(val_weeks(scored)).scalar()
    return inventory.stock_plan(test_weeks(scored), std=std)


def dirty_train(spark, d) -> DataFrame:
    """The panel with known faults in some weeks, for the checks to find."""

    def every(n: int):
        return F.col("week") % n == 0

    return panel(spark, d).select(
        F.when(every(97), None).when(every(89), F.col("week").cast("bigint")).otherwise(F.col("id")).alias("id"),
        "week",
        (F.col("center_id") + F.when(every(67), 10**9).otherwise(0)).alias("center_id"),
        F.when(every(61), 999).otherwise(F.col("meal_id")).alias("meal_id"),
        F.when(every(79), 0.0).otherwise(F.col("checkout_price")).alias("checkout_price"),
        F.when(every(73), -1.0).otherwise(F.col("base_price")).alias("base_price"),
        F.when(every(83), 2).otherwise(F.col("emailer_for_promotion")).alias("emailer_for_promotion"),
        "homepage_featured",
        F.when(every(71), -F.col("num_orders")).otherwise(F.col("num_orders")).alias("num_orders"),
    )


def dirty_tables(spark, d) -> dict[str, DataFrame]:
    return {"train": dirty_train(spark, d), "centers": star.centers(spark, d), "meals": star.meals(spark, d)}


def boosted_frame(spark, d) -> tuple[DataFrame, list[str]]:
    """Feature frame by nation for the tree models, written once."""
    frame, names = whole_frame(spark, d, "nation")
    return stage(frame, "features"), names


def fitted_boost(spark, d) -> tuple[BoostedForecaster, DataFrame]:
    frame, names = boosted_frame(spark, d)
    train = frame.filter(F.col("week") <= SPLIT.train_end)
    return BoostedForecaster(names, SMALL_BOOST).fit(train), frame


def elastic_scored(spark, d) -> tuple[ProfileForecaster, DataFrame]:
    frame = stage(priced(panel(spark, d)), "priced")
    return ProfileForecaster().fit(frame), frame


# --- sources and sinks -----------------------------------------------------------------------------


def _write_raw(spark, d) -> str:
    folder = fresh_folder(spark, "raw")
    for name, df in star.star_tables(spark, d).items():
        df.write.option("header", True).csv(f"{folder}/{CONTRACTS[name].file}")
    return folder


@query
def load_tables(spark, d):
    return table_reader.load_tables(spark, _write_raw(spark, d))["train"]


def _written_features(spark, d) -> str:
    folder = fresh_folder(spark, "features")
    frame = priced(series.history_features(panel(spark, d), one_row_per_week=True))
    artifacts.write_features(frame, folder)
    return folder


@query
def read_features(spark, d):
    back = artifacts.read_features(spark, _written_features(spark, d))
    return tidy(back.select(*ID, "price_ratio", *HISTORY))


@query
def write_features(spark, d):
    back = spark.read.parquet(_written_features(spark, d))
    return back.groupBy("week_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("num_orders").alias("units"), *[F.count(c).alias(c) for c in HISTORY]
    )


def _written_plan(spark, d) -> DataFrame:
    folder = fresh_folder(spark, "plan")
    plan = test_plan(spark, d).select(*inventory.PLAN_COLUMNS)
    artifacts.write_plan(plan, folder)
    return artifacts.read_plan(spark, folder, plan.schema)


@query
def read_plan(spark, d):
    return tidy(_written_plan(spark, d))


@query
def write_plan(spark, d):
    back = _written_plan(spark, d)
    return tidy(
        back.groupBy("meal_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("forecast_orders").alias("forecast_orders"),
            F.sum("recommended_preparation").alias("recommended_preparation"),
        )
    )


@query
def write_metrics(spark, d):
    df = stage(split_scored(staged_panel(spark, d)), "scored")
    plan = inventory.stock_plan(test_weeks(df), std=inventory.residual_rmse(val_weeks(df)).scalar())
    row = artifacts.metrics_row(
        {"baseline_metrics": forecast.score(test_weeks(df)), "inventory_kpis": inventory.plan_totals(plan)}
    )
    folder = fresh_folder(spark, "metrics")
    artifacts.write_metrics(row, folder)
    return artifacts.read_metrics(spark, folder, row.schema).select("baseline_metrics.*", "inventory_kpis.*")


@query
def write_codes(spark, d):
    """The codes of all category columns, written and read back."""
    _, codes = features.encode_categories(enriched(spark, d, staged=True), FeatureSpec().categorical)
    folder = fresh_folder(spark, "codes")
    artifacts.write_codes(codes, folder)
    parts = [df.withColumn("column", F.lit(name)) for name, df in artifacts.read_codes(spark, folder).items()]
    return reduce(DataFrame.unionByName, parts).select("column", "value", "code")


@query
def model_persistence(spark, d):
    model, frame = fitted_boost(spark, d)
    folder = fresh_folder(spark, "model")
    model.save(folder)
    loaded = BoostedForecaster.load(spark, folder)
    test = test_weeks(frame)
    both = loaded.transform(model.transform(test).withColumnRenamed(FORECAST, "kept"))
    differing = F.count_if(F.col("kept") != F.col(FORECAST)).cast("bigint").alias("differing")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kept") < 0).cast("bigint").alias("negative"), differing)


def _log(spark, d, max_history: int | None = None) -> adaptive.FeedbackLog:
    log = adaptive.FeedbackLog(spark, fresh_folder(spark, "feedback"), max_history)
    scored = stage(split_scored(staged_panel(spark, d)), "scored")
    log.record(val_weeks(scored), 1)
    log.record(test_weeks(scored), 2)
    return log


@query
def feedback_export(spark, d):
    return _log(spark, d).read().drop("recorded_at")


# --- validation ------------------------------------------------------------------------------------


def _column_check(spark, d, find) -> DataFrame:
    """Rows and column findings of each table; ``train`` comes without its target and with one column too many."""
    tables = star.star_tables(spark, d)
    tables["train"] = tables["train"].drop("num_orders").withColumn("surplus", F.lit(1))
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table"), "n", F.lit(",".join(find(df, CONTRACTS[name].columns))).alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def check_required_columns(spark, d):
    return _column_check(spark, d, quality.missing_columns)


@query
def check_extra_columns(spark, d):
    return _column_check(spark, d, quality.extra_columns)


@query
def check_columns_legacy(spark, d):
    """The raising form: the first table passes, the message of the second one is kept."""

    def find(df, columns):
        try:
            quality.require_columns(df, columns)
            return []
        except ValueError as err:
            return [str(err)]

    return _column_check(spark, d, find)


def _one_check(spark, d, *checks) -> DataFrame:
    found = quality.table_violations(dirty_train(spark, d), CONTRACTS["train"])
    return found.filter(F.col("check").isin(*checks)).select("check", "column", "violations")


@query
def check_pk_null(spark, d):
    return _one_check(spark, d, "pk_null")


@query
def check_pk_duplicates(spark, d):
    return quality.duplicate_keys(dirty_train(spark, d), "id")


@query
def check_binary_domain(spark, d):
    return quality.binary_outliers(dirty_train(spark, d), "emailer_for_promotion")


@query
def check_positive(spark, d):
    return _one_check(spark, d, "not_positive")


@query
def check_non_negative(spark, d):
    return _one_check(spark, d, "negative")


@query
def check_foreign_keys(spark, d):
    return quality.relationship_violations(dirty_tables(spark, d))


@query
def violation_report(spark, d):
    return quality.violation_report(dirty_tables(spark, d))


# --- projections and filters -----------------------------------------------------------------------


@query
def time_split(spark, d):
    return (
        split.with_split(panel(spark, d), split=SPLIT)
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("week").alias("first_week"),
            F.max("week").alias("last_week"),
            F.sum("num_orders").alias("units"),
        )
    )


@query
def select_features(spark, d):
    """Every feature column of the whole frame: prices, promotions, calendar, history and codes."""
    frame, _ = whole_frame(spark, d, impute=False)
    return tidy(frame.select(*features.feature_columns(frame)), 4)


@query
def dashboard_filter(spark, d):
    return tidy(split.equal_to(panel(spark, d), center_id=7, meal_id=103))


@query
def fold_filter(spark, d):
    return tidy(split.week_range(panel(spark, d), 329, 338))


@query
def half_split(spark, d):
    return (
        split.half_split(staged_panel(spark, d))
        .groupBy("side")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("week").alias("first_week"),
            F.max("week").alias("last_week"),
            F.sum("num_orders").alias("units"),
        )
    )


@query
def impute_zero(spark, d):
    known = series.history_features(panel(spark, d), one_row_per_week=True)
    return tidy(features.impute_zero(known).select("id", *HISTORY))


@query
def random_sample(spark, d):
    return tidy(split.fixed_sample(panel(spark, d), 1000).select("id", "checkout_price", "num_orders"))


@query
def distinct_values(spark, d):
    return split.distinct_values(panel(spark, d), ["center_id", "meal_id", "week"])


# --- joins -----------------------------------------------------------------------------------------

ENRICHED = ["id", "center_type", "city_code", "region_code", "op_area", "category", "cuisine", "num_orders"]


@query
def enrich_left(spark, d):
    centers, meals = stage(star.centers(spark, d), "centers"), stage(star.meals(spark, d), "meals")
    return features.enrich(dirty_train(spark, d), centers, meals).select(*ENRICHED)


@query
def enrich_inner(spark, d):
    centers, meals = stage(star.centers(spark, d), "centers"), stage(star.meals(spark, d), "meals")
    return features.enrich(dirty_train(spark, d), centers, meals, "inner").select(*ENRICHED)


@query
def baseline_lookup(spark, d):
    df = staged_panel(spark, d)
    train = df.filter(F.col("week") <= SPLIT.train_end)
    medians = stage(forecast.median_table(train, KEYS, "num_orders"), "medians")
    overall = forecast.overall_median(train, "num_orders").scalar()
    return forecast.apply_medians(test_weeks(df), medians, overall, KEYS).select(*ID, FORECAST)


@query
def profile_lookup(spark, d):
    """Profiles of the validation weeks applied to the test weeks; pairs without one keep the defaults."""
    scored = stage(split_scored(staged_panel(spark, d)), "scored")
    found = stage(profiles.sku_profiles(val_weeks(scored)), "profiles")
    return tidy(
        profiles.adaptive_forecast(test_weeks(scored), found).select(*ID, "adaptive_orders", "adaptive_stock")
    )


@query
def fold_range_join(spark, d):
    df = staged_panel(spark, d)
    bounds = bt.fold_bounds(df, WALK)
    parts = [
        bt.in_folds(df, bounds, part, WALK)
        .groupBy("fold_index")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("num_orders").alias("units"))
        .withColumn("part", F.lit(part))
        for part in ("train", "test")
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def policy_cross_join(spark, d):
    rows = inventory.policy_rows(test_weeks(split_scored(staged_panel(spark, d))))
    return tidy(rows.select(*ID, "service_level", "prepared", "fulfilled", "stockout", "wasted"))


SCENARIO_COLUMNS = [
    "checkout_price",
    "price_ratio",
    "discount_ratio",
    "emailer_for_promotion",
    "homepage_featured",
    "both_promos",
    "any_promo",
    "promo_discount_synergy",
]


def _scenario_sums(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in SCENARIO_COLUMNS])


@query
def scenario_cross_join(spark, d):
    rows = scenarios.all_scenarios(priced(panel(spark, d)))
    return tidy(_scenario_sums(rows, "scenario", "center_id", "meal_id"), 4)


@query
def category_lookup(spark, d):
    """Codes of all category columns learned on the first weeks, looked up for all rows; a value seen later gets -1."""
    df = enriched(spark, d, staged=True)
    early = df.filter(F.col("week") <= 2)
    columns = FeatureSpec().categorical
    _, codes = features.encode_categories(early, columns)
    coded, _ = features.encode_categories(df, columns, codes)
    return coded.select("id", *columns)


@query
def fk_anti_join(spark, d):
    return quality.unmapped_keys(dirty_train(spark, d), star.centers(spark, d), "center_id")


# --- aggregations ----------------------------------------------------------------------------------


@query
def group_median_fit(spark, d):
    train = panel(spark, d).filter(F.col("week") <= SPLIT.train_end)
    return forecast.median_table(train, KEYS, "num_orders")


@query
def group_median_long_groups(spark, d):
    """Groups of regions, which have more than 100 distinct values, go the way of the very large ones."""
    train = panel(spark, d, "region").filter(F.col("week") <= SPLIT.train_end)
    return group_median(train, KEYS, "num_orders", "group_median", light_rows=100)


@query
def overall_median(spark, d):
    return forecast.overall_median(panel(spark, d).filter(F.col("week") <= SPLIT.train_end), "num_orders")


@query
def price_quantiles_long_groups(spark, d):
    """Deciles of the price per meal, cut into pieces."""
    counts = value_counts(panel(spark, d), ["meal_id"], "checkout_price")
    found = exact_quantiles(counts, ["meal_id"], [i / 10 for i in range(11)], light_rows=100, pieces=16)
    return tidy(found.select("meal_id", F.posexplode("quantiles").alias("decile", "price")))


@query
def baseline_forecast(spark, d):
    df = staged_panel(spark, d)
    model = MedianForecaster().fit(df.filter(F.col("week") <= SPLIT.train_end))
    return model.transform(df).select("id", FORECAST)


def _test_scored(spark, d) -> DataFrame:
    return test_weeks(split_scored(staged_panel(spark, d)))


@query
def sketched_medians(spark, d):
    """Medians per center merged from sketches by blocks of weeks, the later weeks added apart; and their exact ranks."""
    frame = staged_panel(spark, d)
    table = SketchTable(spark, fresh_folder(spark, "sketches"), ["center_id"], "num_orders")
    last = frame.agg(F.max("week")).first()[0] // table.block_weeks * table.block_weeks
    table.add(frame.filter(F.col("week") <= last))
    table.add(frame.filter(F.col("week") > last))
    found = stage(table.quantiles([0.5]).select("center_id", "n", F.col("quantiles")[0].alias("median")), "medians")
    below = F.avg((F.col("num_orders") < F.col("median")).cast("double"))
    upto = F.avg((F.col("num_orders") <= F.col("median")).cast("double"))
    near = (below <= 0.5 + 2 * RANK_ERROR) & (upto >= 0.5 - 2 * RANK_ERROR)
    return frame.join(found, "center_id").groupBy("center_id").agg(F.max("n").alias("n"), near.alias("near"))


@query
def metric_wmape(spark, d):
    return tidy(_test_scored(spark, d).groupBy("meal_id").agg(scores.wmape("num_orders", FORECAST).alias("wmape")))


@query
def metric_rmsle(spark, d):
    return tidy(_test_scored(spark, d).groupBy("meal_id").agg(scores.rmsle("num_orders", FORECAST).alias("rmsle")))


@query
def metric_suite(spark, d):
    return forecast.score(_test_scored(spark, d), by=["center_id"])


@query
def evaluate_model(spark, d):
    df = staged_panel(spark, d)
    return MedianForecaster().fit(df.filter(F.col("week") <= SPLIT.train_end)).evaluate(test_weeks(df))


@query
def residual_rmse(spark, d):
    return tidy(inventory.residual_rmse(val_weeks(split_scored(staged_panel(spark, d)))))


@query
def inventory_kpis(spark, d):
    return inventory.plan_totals(test_plan(spark, d))


@query
def sliced_metrics(spark, d):
    scored = test_weeks(split_scored(enriched(spark, d, staged=True)))
    return slices.sliced_scores(scored)


@query
def fold_metrics(spark, d):
    return bt.backtest(staged_panel(spark, d), walk=WALK).folds


@query
def overall_backtest_metrics(spark, d):
    return bt.backtest(staged_panel(spark, d), walk=WALK).overall


@query
def policy_replay(spark, d):
    return inventory.replay_report(inventory.policy_replay(_test_scored(spark, d)))


def with_gaps(df: DataFrame) -> DataFrame:
    """Demand, price and forecast missing in some weeks."""

    def gap(name: str, n: int):
        return F.when(F.col("week") % n != 0, F.col(name)).alias(name)

    gaps = {"num_orders": 11, "actual_orders": 11, "checkout_price": 13, FORECAST: 17}
    return df.select(*[gap(c, gaps[c]) if c in gaps else F.col(c) for c in df.columns])


@query
def policy_replay_gaps(spark, d):
    """The replay where demand or forecast is missing in some weeks."""
    return inventory.replay_report(inventory.policy_replay(with_gaps(_test_scored(spark, d))))


@query
def optimal_policy(spark, d):
    return inventory.best_policy(inventory.policy_replay(_test_scored(spark, d)))


def _profile_input(spark, d) -> DataFrame:
    """All weeks with the median forecast of the training weeks and the promotion flag."""
    df = staged_panel(spark, d)
    model = MedianForecaster().fit(df.filter(F.col("week") <= SPLIT.train_end))
    return stage(priced(model.transform(df)), "profile-input")


@query
def sku_profile(spark, d):
    return profiles.sku_profiles(_profile_input(spark, d))


@query
def sku_profile_colocated(spark, d):
    """Profiles from a panel that is written by series; the forecast and what each row gives are worked out on reading.

    The panel is read three times to write it, so it is written without its forecast, whose lookup would run three times.
    """
    table = SeriesTable.write(staged_panel(spark, d), fresh_folder(spark, "series")).series()
    model = MedianForecaster().fit(table.filter(F.col("week") <= SPLIT.train_end))
    return profiles.sku_profiles(priced(model.transform(table)))


@query
def sku_profile_gaps(spark, d):
    """Profiles where demand, price or forecast is missing in some weeks."""
    return profiles.sku_profiles(with_gaps(_profile_input(spark, d)))


@query
def adaptive_correction_gaps(spark, d):
    """Corrected forecasts where demand or forecast is missing in some weeks."""
    scored = with_gaps(stage(split_scored(staged_panel(spark, d)), "scored"))
    found = stage(profiles.sku_profiles(val_weeks(scored)), "profiles")
    return tidy(profiles.adaptive_forecast(test_weeks(scored), found).select(*ID, "adaptive_orders", "adaptive_stock"))


@query
def residual_bias(spark, d):
    return tidy(profiles.profile_numbers(_profile_input(spark, d)).select(*KEYS, "bias", "std"))


@query
def promo_uplift(spark, d):
    return tidy(profiles.profile_numbers(_profile_input(spark, d)).select(*KEYS, "uplift"))


@query
def price_elasticity(spark, d):
    return tidy(profiles.profile_numbers(_profile_input(spark, d)).select(*KEYS, "elasticity"))


@query
def profile_tiers(spark, d):
    found = profiles.sku_profiles(_profile_input(spark, d))
    return found.groupBy("volatility_tier", "volume_tier").agg(F.count(F.lit(1)).alias("pairs"))


@query
def profile_safety_stock(spark, d):
    return profiles.sku_profiles(_profile_input(spark, d)).select(*KEYS, "recommended_safety_stock")


@query
def feedback_summary(spark, d):
    return _log(spark, d).summary()


@query
def feedback_summary_newest(spark, d):
    """The newest 4000 records only: whole batches by their sums, the one cut by the limit by its records."""
    return _log(spark, d, 4000).summary()


@query
def weekly_totals(spark, d):
    return tidy(explore.weekly_totals(test_plan(spark, d)))


@query
def weekly_network_demand(spark, d):
    return explore.weekly_demand(panel(spark, d))


@query
def promo_combo_mean(spark, d):
    return tidy(explore.promo_means(panel(spark, d)))


@query
def demand_histogram(spark, d):
    df = panel(spark, d).select("num_orders")
    raw = explore.histogram(df, "num_orders").withColumn("scale", F.lit("raw"))
    logged = explore.histogram(df, F.log1p(F.col("num_orders"))).withColumn("scale", F.lit("log"))
    return tidy(raw.unionByName(logged))


@query
def demand_skewness(spark, d):
    return tidy(explore.demand_skewness(panel(spark, d)))


@query
def prediction_total(spark, d):
    model, frame = elastic_scored(spark, d)
    scored = model.transform(scenarios.all_scenarios(frame))
    return tidy(scored.groupBy("scenario").agg(F.sum(FORECAST).alias("total")), 3)


# --- windows ---------------------------------------------------------------------------------------


@query
def lag_features(spark, d):
    lagged = series.lag_features(panel(spark, d), one_row_per_week=True)
    return lagged.select("id", *[f"num_orders_lag_{n}" for n in FeatureSpec().lags])


@query
def lag_features_long_series(spark, d):
    """Series of regions, which have more than 100 weeks, are cut into pieces with carried rows."""
    lagged = series.lag_features(staged_panel(spark, d, "region"), light_rows=100)
    return lagged.select("id", *[f"num_orders_lag_{n}" for n in FeatureSpec().lags])


@query
def lag_features_colocated(spark, d):
    """Lags from a panel that is written by series: no shuffle after the write."""
    table = SeriesTable.write(staged_panel(spark, d), fresh_folder(spark, "series"), order=["week", "id"])
    lagged = series.lag_features(table.series(), one_row_per_week=True)
    return lagged.select("id", *[f"num_orders_lag_{n}" for n in FeatureSpec().lags])


@query
def rolling_mean(spark, d):
    rolled = series.rolling_features(panel(spark, d), one_row_per_week=True)
    return tidy(rolled.select("id", *[f"num_orders_roll_mean_{k}" for k in FeatureSpec().windows]))


@query
def rolling_std(spark, d):
    rolled = series.rolling_features(panel(spark, d), one_row_per_week=True)
    return tidy(rolled.select("id", *[f"num_orders_roll_std_{k}" for k in FeatureSpec().windows]), 4)


@query
def rolling_long_series(spark, d):
    rolled = series.rolling_features(staged_panel(spark, d, "region"), light_rows=100)
    return tidy(rolled.select("id", "num_orders_roll_mean_10", "num_orders_roll_std_5"), 4)


@query
def meal_rel_price(spark, d):
    return tidy(features.relative_price(staged_panel(spark, d)).select("id", "meal_rel_price"))


@query
def category_codes(spark, d):
    df = enriched(spark, d)
    columns = list(FeatureSpec().categorical)
    _, codes = features.encode_categories(df, columns)
    parts = [
        codes[c].select(F.lit(c).alias("column"), F.col("value").cast("string").alias("value"), "code") for c in columns
    ]
    return reduce(DataFrame.unionByName, parts)


def _sides(spark, d) -> DataFrame:
    return split.half_split(stage(features.calendar_features(priced(panel(spark, d))), "priced"))


@query
def ks_cumulative(spark, d):
    from ..operators.heavy import cumulate

    counts = stage(drift.side_counts(_sides(spark, d), ["checkout_price", "num_orders"]), "counts")
    steps = cumulate(counts.filter("value IS NOT NULL"), "feature", ["baseline_rows", "current_rows"])
    return tidy(steps, 9).select("feature", "value", "upto_baseline_rows", "upto_current_rows")


@query
def trailing_rank(spark, d):
    ranked = series.last_rows(panel(spark, d), KEYS, ["week", "id"], 10)
    return ranked.select(*ID, F.col("rank").cast("int").alias("rank"), "num_orders")


# --- sorts and limits ------------------------------------------------------------------------------


@query
def panel_sort(spark, d):
    return panel(spark, d).orderBy(*KEYS, "week").select(*ID, "num_orders")


@query
def top_features(spark, d):
    model, _ = fitted_boost(spark, d)
    return model.importances(12)


@query
def plan_head(spark, d):
    return tidy(inventory.plan_head(test_plan(spark, d)))


@query
def profiles_head(spark, d):
    return profiles.profiles_head(profiles.sku_profiles(_profile_input(spark, d)))


@query
def last_n_history(spark, d):
    return _log(spark, d, 500).read().drop("recorded_at")


@query
def unmapped_sample(spark, d):
    found = quality.unmapped_keys(dirty_train(spark, d), star.centers(spark, d), "center_id")
    return quality.unmapped_sample(found)


@query
def psi_top15_banded(spark, d):
    return drift.banded_scores(drift.feature_drift(_sides(spark, d), DRIFT_FEATURES))


# --- set operations --------------------------------------------------------------------------------


@query
def concat_folds(spark, d):
    return bt.backtest(staged_panel(spark, d), walk=WALK).predictions.select(*ID, "fold_index", FORECAST)


@query
def key_difference(spark, d):
    return quality.unmapped_keys(dirty_train(spark, d), star.meals(spark, d), "meal_id")


@query
def append_feedback(spark, d):
    """Two batches appended and one of them sent again."""
    log = adaptive.FeedbackLog(spark, fresh_folder(spark, "feedback"))
    scored = stage(split_scored(staged_panel(spark, d)), "scored")
    log.record(val_weeks(scored), 1)
    log.record(test_weeks(scored), 2)
    log.record(test_weeks(scored), 2)
    return log.everything().groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("actual_orders").alias("units"))


@query
def scenario_union(spark, d):
    model, frame = elastic_scored(spark, d)
    totals = scenarios.scenario_totals(model.transform(scenarios.all_scenarios(frame)))
    return tidy(totals.select("scenario", "total", "prep", "buffer"), 3)


# --- scalar expressions ----------------------------------------------------------------------------


@query
def price_features(spark, d):
    df = features.price_features(dirty_train(spark, d))
    return tidy(df.select("id", "discount_amount", "discount_ratio", "price_ratio"), 4)


@query
def promo_features(spark, d):
    df = priced(panel(spark, d))
    return tidy(df.select("id", "both_promos", "any_promo", "promo_discount_synergy"))


@query
def calendar_features(spark, d):
    return features.calendar_features(panel(spark, d)).select("id", "week_of_year", "month_proxy", "quarter_proxy")


@query
def cyclical_encoding(spark, d):
    df = features.calendar_features(panel(spark, d))
    return tidy(df.select("id", "sin_week_of_year", "cos_week_of_year"))


@query
def naive_discount_ratio(spark, d):
    return tidy(panel(spark, d).select("id", pricing.plain_discount_ratio().alias("discount_ratio")))


@query
def log_target(spark, d):
    y = F.log1p(F.col("num_orders"))
    return tidy(panel(spark, d).select("id", y.alias("y"), F.greatest(F.expm1(y), F.lit(0.0)).alias("back")))


@query
def z_score(spark, d):
    """Service level of each row taken from its discount, so that listed and unlisted levels occur."""
    level = F.round(0.75 + pricing.discount_ratio() * 2.5, 3)
    df = panel(spark, d).select("id", level.alias("level"))
    return df.select("id", "level", stock.z_score_of("level").alias("z"))


@query
def safety_stock(spark, d):
    """Per-row deviation: the rolling deviation of each series."""
    rolled = series.rolling_features(panel(spark, d), windows=(10,), one_row_per_week=True)
    return rolled.select("id", stock.safety_stock("num_orders_roll_std_10").alias("safety_stock"))


@query
def recommend_row(spark, d):
    scored = _test_scored(spark, d)
    out = inventory.recommend(
        scored, std=F.col("num_orders") / 4, on_hand="num_orders", policy=replace(SETTINGS.stock, lead_time_weeks=2)
    )
    return out.select(*ID, "forecast_demand", "safety_stock", "recommended_preparation", "reorder_point")


@query
def inventory_plan(spark, d):
    return tidy(test_plan(spark, d).select(*inventory.PLAN_COLUMNS))


@query
def adaptive_correction(spark, d):
    scored = stage(split_scored(staged_panel(spark, d)), "scored")
    corrected, _ = adaptive.correct_batch(test_weeks(scored), _Ready())
    return tidy(corrected.select(*ID, "adaptive_orders", "adaptive_stock"))


@query
def adaptive_correction_colocated(spark, d):
    """Profiles and their lookup, both bucket by bucket."""
    scored = test_weeks(stage(split_scored(staged_panel(spark, d)), "scored"))
    rows = SeriesTable.write(scored, fresh_folder(spark, "series")).series()
    corrected = profiles.adaptive_forecast(rows, profiles.sku_profiles(rows))
    return tidy(corrected.select(*ID, "adaptive_orders", "adaptive_stock"))


class _Ready(forecast.Forecaster):
    """For frames that carry their forecast already."""

    def fit(self, df, validation=None):
        return self

    def transform(self, df):
        return df


@query
def feedback_record(spark, d):
    return adaptive.feedback_rows(_test_scored(spark, d), 1).drop("recorded_at", "batch_id")


def _one_scenario(spark, d, key: str) -> DataFrame:
    rows = scenarios.apply_scenario(priced(panel(spark, d)), key)
    return tidy(_scenario_sums(rows, "center_id", "meal_id"), 4)


@query
def scenario_price_surge(spark, d):
    return _one_scenario(spark, d, "price_surge")


@query
def scenario_flash_sale(spark, d):
    return _one_scenario(spark, d, "flash_sale")


@query
def scenario_promo_blitz(spark, d):
    return _one_scenario(spark, d, "promo_blitz")


@query
def scenario_blackout(spark, d):
    return _one_scenario(spark, d, "blackout")


def _outcomes(spark, d) -> DataFrame:
    model, frame = elastic_scored(spark, d)
    return scenarios.stress_test(frame, model)


@query
def scenario_outcome(spark, d):
    return _outcomes(spark, d).drop("description", "position")


@query
def stress_verdict(spark, d):
    return scenarios.stress_verdict(_outcomes(spark, d))


@query
def replay_timeline(spark, d):
    return tidy(inventory.replay_timeline(_test_scored(spark, d)))


@query
def improvement_pct(spark, d):
    scored = stage(split_scored(staged_panel(spark, d)), "scored")
    corrected, _ = adaptive.correct_batch(test_weeks(scored), _Ready())
    return adaptive.batch_scores(corrected)


# --- drift -----------------------------------------------------------------------------------------


@query
def psi(spark, d):
    counts = drift.drift_counts(_sides(spark, d), DRIFT_FEATURES)
    return tidy(drift.psi(counts))


@query
def psi_long_groups(spark, d):
    """The bin edges found through pieces."""
    counts = drift.drift_counts(_sides(spark, d), DRIFT_FEATURES)
    return tidy(drift.psi(counts, light_rows=10, pieces=16))


@query
def ks_statistic(spark, d):
    counts = drift.drift_counts(_sides(spark, d), DRIFT_FEATURES)
    return tidy(drift.ks_test(counts).select("feature", "ks_statistic"))


@query
def ks_p_value(spark, d):
    counts = drift.drift_counts(_sides(spark, d), DRIFT_FEATURES)
    return tidy(drift.ks_test(counts).select("feature", "ks_p_value"))


@query
def feature_drift(spark, d):
    return tidy(drift.feature_drift(_sides(spark, d), DRIFT_FEATURES))


@query
def target_drift(spark, d):
    return tidy(drift.target_drift(_sides(spark, d)))


def _residual_sides(spark, d) -> DataFrame:
    scored = stage(split_scored(staged_panel(spark, d)), "scored")
    return scored.withColumn("side", F.when(F.col("week") <= SPLIT.val_end, "baseline").otherwise("current"))


@query
def residual_variance_ratio(spark, d):
    return tidy(drift.residual_variance_ratio(_residual_sides(spark, d)))


@query
def drift_status(spark, d):
    sides = _sides(spark, d)
    found = stage(drift.feature_drift(sides, DRIFT_FEATURES), "drift")
    ratio = drift.residual_variance_ratio(_residual_sides(spark, d))
    return tidy(drift.drift_status(found, drift.target_drift(sides), ratio))


@query
def drift_report(spark, d):
    """The nested report, one row per feature with the verdict beside it."""
    report = drift.drift_report(_sides(spark, d), DRIFT_FEATURES)
    return tidy(report.select(*[c for c in report.columns if c != "scores"], F.inline("scores")), 4)


# --- forecasting, backtest, loop -------------------------------------------------------------------


@query
def feature_frame(spark, d):
    frame, names = whole_frame(spark, d)
    return tidy(frame.select("id", *names), 4)


@query
def gbt_forecaster(spark, d):
    frame, names = boosted_frame(spark, d)
    train, test = frame.filter(F.col("week") <= SPLIT.train_end), test_weeks(frame)
    tree = BoostedForecaster(names, PATIENT_BOOST).fit(train, val_weeks(frame))
    median = MedianForecaster().fit(train)
    return forecast.compare({"median": median.transform(test), "boosted": tree.transform(test)}, "median")


@query
def forecaster_interface(spark, d):
    """Any class with fit and transform will do: two of them evaluated the same way."""
    frame = stage(priced(panel(spark, d)), "priced")
    train, test = frame.filter(F.col("week") <= SPLIT.train_end), test_weeks(frame)
    parts = [
        model.fit(train).evaluate(test).withColumn("model", F.lit(name))
        for name, model in {"median": MedianForecaster(), "profile": ProfileForecaster()}.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def feature_importance(spark, d):
    model, _ = fitted_boost(spark, d)
    return model.importances()


@query
def driver_attribution(spark, d):
    model, frame = elastic_scored(spark, d)
    return tidy(shuffle_features(model, frame, ["center_id", "meal_id", "checkout_price", "any_promo"]))


def _linear(spark, d) -> tuple[LinearForecaster, DataFrame]:
    """Price and promotion as features, fitted on the training weeks; and all weeks."""
    frame = stage(priced(panel(spark, d)), "priced")
    return LinearForecaster(["checkout_price", "any_promo"]).fit(frame.filter(F.col("week") <= SPLIT.train_end)), frame


@query
def linear_forecaster(spark, d):
    model, frame = _linear(spark, d)
    return tidy(model.evaluate(test_weeks(frame)), 4)


@query
def linear_attribution(spark, d):
    """What price and promotion add to the linear forecast of every row of the test weeks."""
    model, frame = _linear(spark, d)
    return tidy(model.attribution(test_weeks(frame), ID))


@query
def linear_importance(spark, d):
    model, frame = _linear(spark, d)
    return tidy(mean_attribution(model.attribution(frame, ID)))


@query
def tree_attribution(spark, d):
    """Contributions of all features to every test row along the paths of the trees, against the forecast they add up to."""
    model, frame = fitted_boost(spark, d)
    paths = TreeAttribution(model)
    test = model.transform(test_weeks(frame)).withColumn("parts", paths.parts())
    total = F.aggregate("parts", F.lit(paths.base), lambda a, b: a + b)
    near = F.abs(F.greatest(F.expm1(total), F.lit(0.0)) - F.col(FORECAST)) <= 1e-6 * (1 + F.col(FORECAST))
    return test.agg(F.count(F.lit(1)).alias("n"), F.count_if(near).cast("bigint").alias("added_up"))


@query
def backtest(spark, d):
    return bt.backtest(enriched(spark, d, staged=True), walk=WALK).slices


@query
def backtest_sliding(spark, d):
    return bt.backtest(staged_panel(spark, d), walk=replace(WALK, expanding=False)).folds


@query
def backtest_boosted(spark, d):
    frame, names = boosted_frame(spark, d)
    tree = replace(SMALL_BOOST, trees=3)
    return bt.backtest(frame, lambda: BoostedForecaster(names, tree), walk=WALK).folds


@query
def backtest_boosted_folds(spark, d):
    """Bounds and samples of the folds that the trees were fitted and scored on, and whether each has its measures."""
    folds = QUERIES["backtest_boosted"](spark, d)
    measured = F.col("mae").isNotNull() & F.col("rmse").isNotNull() & F.col("wmape").between(0, 1) & F.col("rmsle").isNotNull()
    bounds = ["fold_index", "train_start", "train_end", "test_start", "test_end", "train_samples", "test_samples"]
    return folds.select(*bounds, measured.alias("measured"))


@query
def boosted_facts(spark, d):
    """What must hold of a fitted tree model, its importances and its scenarios, counted over all rows."""
    model, frame = fitted_boost(spark, d)
    test = stage(model.transform(test_weeks(frame)), "scored")
    median = MedianForecaster().fit(frame.filter(F.col("week") <= SPLIT.train_end)).evaluate(test.drop(FORECAST))
    ranked = stage(model.importances(len(model.features)), "importances")
    total = half_up(F.sum("importance"), 6).alias("importance_total")
    parts = ranked.agg(total, (F.lit(len(model.features)) - F.count_distinct("feature")).alias("unlisted"))
    first = F.max_by("feature", "importance") == F.min_by("feature", "position")
    scenarios_seen = scenarios.stress_test(frame, model).agg(
        F.count(F.lit(1)).alias("scenarios"), F.count_if(F.col("stressed_total_demand") < 0).cast("bigint").alias("negative_totals")
    )
    row = test.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(FORECAST) < 0).cast("bigint").alias("negative"),
        F.count_if(F.col(FORECAST).isNull()).cast("bigint").alias("without_forecast"),
    )
    better = forecast.score(test).select("wmape").scalar() < median.select("wmape").scalar()
    rows = {"rows": row, "listed": parts, "order": ranked.agg(first.alias("best_first")), "what_if": scenarios_seen}
    return artifacts.metrics_row(rows).select(*[f"{name}.*" for name in rows], better.alias("below_median"))


@query
def fold_table(spark, d):
    return bt.fold_table(panel(spark, d), WALK)


@query
def stress_test(spark, d):
    """Scenarios scored by the tree model."""
    model, frame = fitted_boost(spark, d)
    return scenarios.stress_test(frame, model)


def _loop(spark, d, **options) -> tuple[adaptive.AdaptiveLoop, DataFrame]:
    """The loop with the median of the training weeks as its champion, and the test weeks.

    Both are taken from the panel by themselves: the median needs the demand of its weeks only, so neither their prices
    and flags are summed and shuffled nor is the whole panel written, which is far larger than the test weeks.
    """
    whole = panel(spark, d)
    champion = MedianForecaster(one_row_per_week=True).fit(whole.filter(F.col("week") <= SPLIT.train_end))
    log = adaptive.FeedbackLog(spark, fresh_folder(spark, "feedback"))
    return adaptive.AdaptiveLoop(champion, log, **options), priced(stage(test_weeks(whole), "panel"))


@query
def adaptive_loop(spark, d):
    loop, df = _loop(spark, d)
    r = loop.process(df)
    row = (r.champion_wmape, r.adaptive_wmape, r.improvement_pct, r.retrain, len(r.reasons))
    return spark.createDataFrame(
        [row],
        "champion_wmape double, adaptive_wmape double, improvement_pct double, retrain boolean, reasons int",
    )


@query
def adaptive_held_out(spark, d):
    """Champion and corrected WMAPE of the test weeks, each corrected by profiles of the other weeks only."""
    df = stage(priced(panel(spark, d)), "priced")
    champion = MedianForecaster().fit(df.filter(F.col("week") <= SPLIT.train_end))
    return adaptive.batch_scores(adaptive.held_out_correction(test_weeks(df), champion, parts=3, part_weeks=4))


@query
def challenger_promotion(spark, d):
    frame, names = boosted_frame(spark, d)
    champion = MedianForecaster().fit(frame.filter(F.col("week") <= SPLIT.train_end))
    small = replace(SMALL_BOOST, trees=2)  # the rule adds a hundred trees

    def rival(iteration: int) -> BoostedForecaster:
        return BoostedForecaster(names, challenger_spec(small, iteration))

    log = adaptive.FeedbackLog(spark, fresh_folder(spark, "feedback"))
    shelf = fresh_folder(spark, "champion")
    loop = adaptive.AdaptiveLoop(champion, log, challenger=rival, on_promotion=lambda m, n: m.save(f"{shelf}/{n}"))
    r = loop.process(test_weeks(frame), force_retrain=True)
    return spark.createDataFrame(
        [(r.champion_wmape, r.adaptive_wmape, r.challenger_wmape, r.promoted)],
        "champion_wmape double, adaptive_wmape double, challenger_wmape double, promoted boolean",
    )


@query
def challenger_rule(spark, d):
    """A challenger is promoted exactly if its error is below the champion's."""
    r = QUERIES["challenger_promotion"](spark, d)
    follows = F.col("promoted") == (F.col("challenger_wmape") < F.col("champion_wmape"))
    return r.select(follows.alias("follows_rule"), F.col("adaptive_wmape").between(0, 1).alias("measured"))


@query
def training_pipeline(spark, d):
    """The whole run with boosted trees that stop by patience: what it read and wrote, and that it beats the baseline."""
    folder = fresh_folder(spark, "run")
    settings = replace(SETTINGS, boost=PATIENT_BOOST)
    result = training.train(star.star_tables(spark, d), settings, folder=folder, one_row_per_week=True)
    plan = artifacts.read_plan(spark, f"{folder}/data/processed/inventory_recommendations", result.plan.schema)
    metrics = artifacts.read_metrics(spark, f"{folder}/models/metrics", training.summary_row(result).schema)
    beaten = metrics.select(F.col("model_metrics.wmape") < F.col("baseline_metrics.wmape")).scalar()
    saved = BoostedForecaster.load(spark, f"{folder}/models/boosted")
    return plan.agg(
        F.count(F.lit(1)).alias("plan_rows"),
        F.count_if(F.col("forecast_orders") < 0).cast("bigint").alias("negative_forecasts"),
        F.count_if(F.col("recommended_preparation") < F.col("forecast_orders")).cast("bigint").alias("below_forecast"),
        F.lit(result.train_rows).cast("bigint").alias("train_rows"),
        F.lit(result.test_rows).cast("bigint").alias("test_rows"),
        beaten.alias("beats_median"),
        F.lit(saved.features == result.features).alias("model_saved"),
    )


@query
def training_run(spark, d):
    settings = replace(SETTINGS, boost=replace(SMALL_BOOST, trees=5))
    result = training.train(
        star.star_tables(spark, d, "nation"), settings, folder=fresh_folder(spark, "run"), one_row_per_week=True
    )
    return training.summary_row(result)


@query
def training_run_median(spark, d):
    """The same run with the median model in place of the trees: totals of its plan."""
    result = training.train(star.star_tables(spark, d), SETTINGS, forecaster=MedianForecaster(), one_row_per_week=True)
    return result.totals


@query
def model_comparison(spark, d):
    frame = stage(priced(panel(spark, d)), "priced")
    train, test = frame.filter(F.col("week") <= SPLIT.train_end), test_weeks(frame)
    return forecast.compare(
        {
            "median": MedianForecaster().fit(train).transform(test),
            "profile": ProfileForecaster().fit(train).transform(test),
        },
        "median",
    )


# --- streaming -------------------------------------------------------------------------------------


def run_stream(spark, d) -> tuple[FeedbackStream, str]:
    """Test weeks arrive in blocks of weeks; the job is started after each arrival."""
    profiles_folder = fresh_folder(spark, "profile-state")
    loop, source = _loop(spark, d, profiles_folder=profiles_folder)
    landing = fresh_folder(spark, "landing")
    source.limit(0).write.parquet(landing)
    stream = FeedbackStream(spark, landing, source.schema, loop, fresh_folder(spark, "stream"))
    first, last = SPLIT.val_end + 1, SPLIT.total
    for start in range(first, last + 1, ARRIVAL_WEEKS):
        split.week_range(source, start, start + ARRIVAL_WEEKS - 1).write.mode("append").parquet(landing)
        stream.run_available()
    return stream, profiles_folder


@query
def feedback_stream(spark, d):
    stream, _ = run_stream(spark, d)
    return stream.loop.log.everything().drop("recorded_at", "batch_id")


@query
def rolling_reliability(spark, d):
    stream, _ = run_stream(spark, d)
    return stream.loop.log.summary()


@query
def profile_state(spark, d):
    """The profiles in force after the last arrival, from their table."""
    _, folder = run_stream(spark, d)
    return adaptive.newest_profiles(spark, folder)


# --- flagship --------------------------------------------------------------------------------------


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Weekly plan of the test weeks by region: demand, median forecast and recommended preparation."""
    return explore.weekly_totals(test_plan(tune(spark), d, "region"))


@query
def region_plan(spark, d):
    return tidy(flagship(spark, d))


@query
def region_kpis(spark, d):
    return inventory.plan_totals(test_plan(spark, d, "region"))


# The operators' own names for queries that were registered by what they return.
QUERIES["feature_pipeline"] = QUERIES["feature_frame"]
