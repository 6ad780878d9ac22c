import json

import pytest
from conftest import rows
from panels import store_panel, store_rows
from test_backtest_and_scenarios import WALK

from larder.config import BoostSpec, Settings, WeekSplit
from larder.operators.boosted import BoostedForecaster, ModelFileError, NotFitted, challenger_spec, driver_attribution
from larder.operators.forecast import MedianForecaster
from larder.plans import backtest as bt
from larder.plans.adaptive import (
    ABOVE_LIMIT, NO_ROWS, AdaptiveLoop, ChampionShelf, FeedbackLog, correct_batch, feedback_rows, feedback_summary, newest_profiles,
)
from larder.plans.training import train
from larder.session import fresh_folder
from larder.sources import artifacts
from larder.streaming.feedback import FeedbackStream

FEATURES = ["checkout_price", "center_id", "meal_id", "any_promo"]
TINY = BoostSpec(trees=3, depth=2, rate=0.5, row_share=1.0, column_share=1.0, min_rows=1)


@pytest.fixture(scope="module")
def boosted(spark):
    df = store_panel(spark)
    return BoostedForecaster(FEATURES, TINY).fit(df), df


def test_boosted_beats_a_flat_forecast_and_is_never_negative(spark, boosted):
    model, df = boosted
    scored = model.transform(df)
    assert scored.filter("forecast_orders < 0").count() == 0
    flat = MedianForecaster(["no_such_column"]).fit(df)
    assert model.evaluate(df).first().wmape < flat.evaluate(df).first().wmape
    assert scored.columns == [*df.columns, "forecast_orders"]


def test_importances(boosted):
    model, _ = boosted
    got = [r.importance for r in model.importances(2).orderBy("position").collect()]
    assert len(got) == 2 and got == sorted(got, reverse=True)


def test_errors(spark, boosted):
    model, df = boosted
    with pytest.raises(NotFitted):
        BoostedForecaster(FEATURES).transform(df)
    with pytest.raises(NotFitted):
        BoostedForecaster(FEATURES).save("/nowhere")
    with pytest.raises(KeyError, match="any_promo"):
        model.transform(df.drop("any_promo"))


def test_round_trip(spark, boosted):
    model, df = boosted
    folder = fresh_folder(spark, "model")
    model.save(folder)
    loaded = BoostedForecaster.load(spark, folder)
    assert loaded.features == FEATURES and loaded.spec == TINY
    pick = lambda m: rows(m.transform(df).select("id", "forecast_orders"), "id")
    assert pick(loaded) == pick(model)


def test_broken_model_folders(spark, boosted):
    model, _ = boosted
    with pytest.raises(FileNotFoundError):
        BoostedForecaster.load(spark, fresh_folder(spark, "nothing"))

    def saved(text):
        folder = fresh_folder(spark, "broken")
        model.save(folder)
        spark.createDataFrame([(text,)], "value string").write.mode("overwrite").text(f"{folder}/facts")
        return folder

    with pytest.raises(ModelFileError, match="lacks"):
        BoostedForecaster.load(spark, saved(json.dumps({"features": FEATURES})))
    with pytest.raises(ModelFileError):
        BoostedForecaster.load(spark, saved("not json"))
    facts = {"features": FEATURES[::-1], "target": "num_orders", "log_target": True, "spec": {}}
    with pytest.raises(ModelFileError, match="differ"):
        BoostedForecaster.load(spark, saved(json.dumps(facts)))


def test_best_length_follows_the_patience():
    model = BoostedForecaster([], BoostSpec(trees=9, patience=2))
    assert model.best_length([5, 4, 3, 3.5, 3.2, 1]) == 3
    assert model.best_length([5, 4, 4.5, 3, 3.5]) == 4
    assert model.best_length([1]) == 1


def test_validation_shortens_the_model(spark):
    df = store_panel(spark)
    spec = BoostSpec(trees=6, depth=4, rate=1.0, row_share=1.0, column_share=1.0, min_rows=1, patience=1)
    model = BoostedForecaster(["week"], spec).fit(df.filter("week <= 10"), df.filter("week > 20"))
    assert model.model.getNumTrees < 6


def test_challenger_spec():
    spec = challenger_spec(BoostSpec(trees=750, rate=0.011), 3)
    assert (spec.trees, spec.rate, spec.seed) == (800, 0.01, 45)
    assert challenger_spec(BoostSpec(), 1).trees == 700


def test_attribution_finds_the_feature_in_use(spark):
    df = store_panel(spark)
    model = MedianForecaster().fit(df)
    got = {r.feature: r.wmape_change for r in driver_attribution(model, df, ["center_id", "meal_id", "any_promo"]).collect()}
    assert got["any_promo"] == 0.0 and got["center_id"] > 0.01
    blocks = driver_attribution(model, df, ["center_id"], block_rows=10).first().wmape_change
    assert blocks > 0.01


def test_boosted_backtest(spark):
    out = bt.backtest(store_panel(spark), lambda: BoostedForecaster(FEATURES, TINY), walk=WALK)
    assert out.folds.count() == 2 and out.predictions.count() == sum(r[1] >= 24 for r in store_rows(31))


# --- feedback and loop -----------------------------------------------------------------------------

BATCH = "id bigint, week int, center_id bigint, meal_id int, checkout_price double, any_promo int, forecast_orders double, num_orders double"


def realized(spark, weeks=range(1, 15)):
    data = [
        (w * 100 + c + m, w, c, m, 120.0, int(w % 3 == 0), 80.0 + (c % 10) * 10, 90.0 + (c % 10) * 10)
        for w in weeks
        for c in (10, 11)
        for m in (101, 102)
    ]
    return spark.createDataFrame(data, BATCH)


def test_feedback_rows(spark):
    df = realized(spark, [1]).limit(1).selectExpr("week", "center_id", "meal_id", "80.005D as forecast_orders", "0.5D as actual_orders")
    r = feedback_rows(df, 4).first()
    assert (r.batch_id, r.forecast_orders, r.error, r.percentage_error) == (4, 80.01, -79.51, -7950.5)
    with pytest.raises(KeyError, match="actual_orders"):
        feedback_rows(df.drop("actual_orders"))


def test_log_appends_replaces_and_limits(spark):
    log = FeedbackLog(spark, fresh_folder(spark, "log"), max_history=6)
    assert log.read().count() == 0 and log.summary().first().status == "EMPTY"
    for number, weeks in ((1, [1]), (2, [2]), (2, [2])):
        log.record(realized(spark, weeks).withColumnRenamed("num_orders", "actual_orders"), number)
    assert log.everything().count() == 8
    assert rows(log.read().groupBy("batch_id").count(), "batch_id") == [(1, 2), (2, 4)]
    assert log.summary().first().sample_count == 6
    with pytest.raises(ValueError):
        FeedbackLog(spark, "x", 0)


def test_summary(spark):
    data = [(1, 1, 1, 1, 90.0, 100.0, 10.0, 10.0), (1, 2, 1, 1, 110.0, 100.0, -10.0, -10.0), (1, 3, 1, 1, 100.0, 100.0, 0.0, 0.0)]
    log = spark.createDataFrame(
        data,
        "batch_id bigint, week int, center_id bigint, meal_id int, forecast_orders double, actual_orders double, error double, percentage_error double",
    )
    s = feedback_summary(log).first()
    assert (s.sample_count, s.mean_bias_units, s.under_forecast_rate_pct, s.over_forecast_rate_pct) == (3, 0.0, 33.33, 33.33)
    assert s.wmape == 0.0667


class Ready(MedianForecaster):
    """Keeps the forecast that is in the frame."""

    def transform(self, df):
        return df


def test_loop_improves_logs_and_reports(spark):
    loop = AdaptiveLoop(Ready(), FeedbackLog(spark, fresh_folder(spark, "log")))
    result = loop.process(realized(spark))
    assert result.adaptive_wmape < result.champion_wmape and result.improvement_pct > 50
    assert not result.retrain and not result.promoted and result.challenger_wmape is None
    assert loop.profiles.count() == 4 and loop.log.read().count() == 56
    empty = loop.process(realized(spark).limit(0))
    assert empty.reasons == [NO_ROWS] and loop.iteration == 1


def test_forced_retraining_promotes_only_a_better_model(spark):
    promoted = []
    loop = AdaptiveLoop(
        Ready(),
        FeedbackLog(spark, fresh_folder(spark, "log")),
        challenger=lambda i: MedianForecaster(),
        on_promotion=lambda m, n: promoted.append((m, n)),
    )
    first = loop.process(realized(spark), force_retrain=True)
    assert first.retrain and first.promoted and first.challenger_wmape == 0.0 and promoted[0][1] == 1
    second = loop.process(realized(spark).drop("forecast_orders"), force_retrain=True)
    assert not second.promoted and len(promoted) == 1


def test_bad_champion_triggers_retraining(spark):
    df = realized(spark).selectExpr(*[c for c in realized(spark).columns if c != "forecast_orders"], "10.0D as forecast_orders")
    result = AdaptiveLoop(Ready(), FeedbackLog(spark, fresh_folder(spark, "log"))).process(df)
    assert result.retrain and result.reasons == [ABOVE_LIMIT]


def test_stream_equals_batches_and_replay_adds_nothing(spark):
    data = store_panel(spark)
    champion = MedianForecaster().fit(data.filter("week <= 20"))
    landing, state = fresh_folder(spark, "landing"), fresh_folder(spark, "state")
    log = FeedbackLog(spark, fresh_folder(spark, "log"))
    loop = AdaptiveLoop(champion, log, profiles_folder=fresh_folder(spark, "profiles"))
    stream = FeedbackStream(spark, landing, data.schema, loop, state)
    parts = [data.filter("week BETWEEN 21 AND 24"), data.filter("week BETWEEN 25 AND 31")]
    for part in parts:
        part.write.mode("append").parquet(landing)
        stream.run_available()
    got = sorted(rows(log.everything().drop("recorded_at")))
    want = []
    for number, part in enumerate(parts):
        corrected, _ = correct_batch(part, champion)
        frame = corrected.drop("forecast_orders").withColumnRenamed("adaptive_orders", "forecast_orders")
        want += rows(feedback_rows(frame.withColumnRenamed("num_orders", "actual_orders"), number).drop("recorded_at"))
    assert got == sorted(want) and len(got) == sum(r[1] > 20 for r in store_rows(31))
    stream.run_available()  # nothing new
    assert log.everything().count() == len(got)
    loop.process(parts[1], batch_id=1)  # the same batch once more
    assert sorted(rows(log.everything().drop("recorded_at"))) == got


def test_the_log_keeps_every_record_unless_a_limit_is_asked_for(spark):
    many = spark.range(150_000).selectExpr(
        "cast(id % 50 as int) as week", "id as center_id", "1 as meal_id", "1.0D as forecast_orders", "2.0D as actual_orders"
    )
    log = FeedbackLog(spark, fresh_folder(spark, "log"))
    log.record(many, 1)
    assert log.read().count() == log.summary().first().sample_count == 150_000
    assert FeedbackLog(spark, log.folder, max_history=500).read().count() == 500


def test_any_number_of_codes_can_be_written(spark):
    codes = spark.range(10_001).selectExpr("cast(id as string) as value", "cast(id as int) as code")
    folder = fresh_folder(spark, "codes")
    artifacts.write_codes({"a": codes, "b": codes.limit(3)}, folder)
    back = artifacts.read_codes(spark, folder)
    assert back["a"].count() == 10_001 and back["b"].count() == 3


class Level(MedianForecaster):
    """A constant that can be saved."""

    def __init__(self, level=0.0):
        self.level = level

    def fit(self, df, validation=None):
        self.level = df.agg({"num_orders": "avg"}).first()[0]
        return self

    def transform(self, df):
        from pyspark.sql import functions as F

        return df.drop("forecast_orders").withColumn("forecast_orders", F.lit(float(self.level)))

    def save(self, folder):
        from pyspark.sql import SparkSession

        SparkSession.getActiveSession().createDataFrame([(float(self.level),)], "level double").write.mode("overwrite").json(folder)

    @classmethod
    def load(cls, spark, folder):
        return cls(spark.read.json(folder).first().level)


def test_restart_after_a_promotion_repeats_a_batch_exactly(spark):
    places = [fresh_folder(spark, name) for name in ("log", "shelf", "profiles")]
    seeds = []

    def rival(number):
        seeds.append(number)
        return Level()

    def loop():
        shelf = ChampionShelf(spark, places[1], Level)
        return AdaptiveLoop(Level(1.0), FeedbackLog(spark, places[0]), challenger=rival, profiles_folder=places[2], shelf=shelf)

    data = store_panel(spark)
    parts = [data.filter("week <= 10"), data.filter("week BETWEEN 11 AND 20"), data.filter("week > 20")]
    first = loop()
    results = [first.process(part, batch_id=n) for n, part in enumerate(parts)]
    assert [r.promoted for r in results][0] and seeds[0] == 0
    log = sorted(rows(first.log.everything().drop("recorded_at")))
    again = loop()
    assert again.process(parts[1], batch_id=1) == results[1]
    assert again.process(parts[2], batch_id=2) == results[2]
    assert loop().process(parts[0], batch_id=0) == results[0]
    assert sorted(rows(again.log.everything().drop("recorded_at"))) == log
    assert newest_profiles(spark, places[2]).count() == 6


# --- written results -------------------------------------------------------------------------------


def test_feature_table_round_trip_reads_only_its_weeks(spark):
    df = spark.range(1, 201).selectExpr("id", "cast(id as int) as week", "cast(id as double) as num_orders")
    folder = fresh_folder(spark, "features")
    artifacts.write_features(df, folder)
    assert sorted(rows(artifacts.read_features(spark, folder).select("id"))) == sorted(rows(df.select("id")))
    part = artifacts.read_features(spark, folder, 105, 160)
    assert part.count() == 56
    assert "PartitionFilters: [isnotnull(week_bucket" in part._jdf.queryExecution().executedPlan().toString()


def test_training_writes_everything(spark):
    df = store_panel(spark)
    raw = ["id", "week", "center_id", "meal_id", "checkout_price", "base_price", "emailer_for_promotion", "homepage_featured", "num_orders"]
    tables = {
        "train": df.select(*raw),
        "centers": df.selectExpr("center_id", "500 AS city_code", "30 AS region_code", "center_type", "2.5D AS op_area").distinct(),
        "meals": df.select("meal_id", "category", "cuisine").distinct(),
    }
    folder = fresh_folder(spark, "run")
    settings = Settings(split=WeekSplit(20, 24, 31), boost=TINY)
    result = train(tables, settings, folder=folder)
    assert len(result.features) == 37 and (result.train_rows, result.test_rows) == (
        sum(r[1] <= 20 for r in store_rows(31)),
        sum(r[1] > 24 for r in store_rows(31)),
    )
    assert result.top_features.count() == 15 and result.totals.first().total_forecasted_units > 0
    assert spark.read.json(f"{folder}/models/metrics").first().baseline_metrics.wmape > 0
    codes = artifacts.read_codes(spark, f"{folder}/models/codes")
    assert rows(codes["center_type"], "value") == [("CITY", 0), ("ROAD", 1)]
    back = artifacts.read_plan(spark, f"{folder}/data/processed/inventory_recommendations", result.plan.schema)
    assert back.count() == result.test_rows
    assert BoostedForecaster.load(spark, f"{folder}/models/boosted").features == result.features
    with pytest.raises(ValueError):
        train(tables, Settings(split=WeekSplit(24, 20, 31)), forecaster=MedianForecaster())
