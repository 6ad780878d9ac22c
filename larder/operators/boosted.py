"""Boosted-tree forecaster on MLlib, its persistence and its explanation."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, replace
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import BoostSpec
from ..functions import scores
from ..functions.numbers import at_least
from ..session import fresh_folder, remove, scratch, shared_folder, ship
from ..sources.staging import stage
from . import histograms
from .forecast import FORECAST, Forecaster

VECTOR, LABEL, RAW = "_features", "_label", "_raw"
SO_FAR, RESIDUAL = "_so_far", "_residual"
BLOCK = 10  # trees between two looks at the validation rows
VECTOR_ROWS = 100_000  # training rows up to which trees with a patience are MLlib's own, which holds them as vectors


class NotFitted(RuntimeError):
    """The forecaster has no model yet."""


class ModelFileError(ValueError):
    """A saved model is incomplete or of the wrong kind."""


class BoostedForecaster(Forecaster):
    """Gradient-boosted trees on log1p of the target, clipped at 0.

    MLlib has no L2 penalty, and it measures gain per row, so no gain threshold is set. With a validation frame
    training stops once ``patience`` trees brought no improvement there, and the trees up to the best one are
    kept. MLlib's own early stopping has no patience, so its trees are then fitted one by one to the residuals; beyond
    ``VECTOR_ROWS`` training rows they are grown from ``histograms``, which hold a byte for each row and feature.
    """

    def __init__(
        self,
        features: Sequence[str],
        spec: BoostSpec = BoostSpec(),
        target: str = "num_orders",
        log_target: bool = True,
        max_bins: int = 64,
    ) -> None:
        self.features, self.spec, self.target = list(features), spec, target
        self.log_target, self.max_bins = log_target, max_bins
        self.model: GBTRegressionModel | None = None

    def _assembler(self) -> VectorAssembler:
        return VectorAssembler(inputCols=self.features, outputCol=VECTOR, handleInvalid="keep")

    def _label(self) -> Column:
        return F.log1p(self.target) if self.log_target else F.col(self.target)

    def _prepare(self, df: DataFrame) -> DataFrame:
        slim = df.select(*[F.col(c).cast("double").alias(c) for c in self.features], self._label().alias(LABEL))
        return self._assembler().transform(slim).select(VECTOR, LABEL)

    def _regressor(self, trees: int) -> GBTRegressor:
        s = self.spec
        return GBTRegressor(
            featuresCol=VECTOR,
            labelCol=LABEL,
            predictionCol=RAW,
            maxIter=trees,
            maxDepth=s.depth,
            stepSize=s.rate,
            subsamplingRate=s.row_share,
            featureSubsetStrategy="all" if s.column_share >= 1 else str(s.column_share),
            minInstancesPerNode=s.min_rows,
            seed=s.seed,
            maxBins=self.max_bins,
            checkpointInterval=10,
        )

    def _tree(self, rows: DataFrame, number: int) -> DecisionTreeRegressionModel:
        """One tree fitted to the residuals; the number of the tree sets its seed."""
        s = self.spec
        forest = RandomForestRegressor(
            featuresCol=VECTOR,
            labelCol=RESIDUAL,
            numTrees=1,
            bootstrap=False,
            maxDepth=s.depth,
            subsamplingRate=s.row_share,
            featureSubsetStrategy="all" if s.column_share >= 1 else str(s.column_share),
            minInstancesPerNode=s.min_rows,
            seed=s.seed + number,
            maxBins=self.max_bins,
        )
        return forest.fit(rows).trees[0]

    def _ensemble(self, trees: Sequence[DecisionTreeRegressionModel], weights: Sequence[float]) -> GBTRegressionModel:
        """The trees as one MLlib model; Python has no constructor for it, so the one in the JVM is called."""
        context = SparkSession.getActiveSession().sparkContext
        regression = context._jvm.org.apache.spark.ml.regression
        nodes = context._gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
        shares = context._gateway.new_array(context._jvm.double, len(trees))
        for k, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
            nodes[k], shares[k] = tree._java_obj, float(weight)
        made = regression.GBTRegressionModel(f"gbtr_{uuid4().hex[:12]}", nodes, shares, len(self.features))
        for name, column in {"featuresCol": VECTOR, "labelCol": LABEL, "predictionCol": RAW}.items():
            made.set(made.getParam(name), column)
        return GBTRegressionModel._from_java(made)

    def _fit_with_patience(self, train: DataFrame, held: DataFrame) -> GBTRegressionModel:
        """Least-squares boosting in blocks of trees, until the validation error has stopped falling.

        What the trees so far add up to is a column of both frames, written after each block. So no tree is
        applied or fitted twice beyond its block, and a lost executor costs one block at most.
        """
        trees, weights, errors = [], [], []
        train, held = (df.withColumn(SO_FAR, F.lit(0.0)) for df in (train, held))
        while len(trees) < self.spec.trees and len(trees) - self.best_length(errors or [0.0]) < self.spec.patience:
            first, cached = len(trees), train.persist()
            try:
                for number in range(first, min(first + BLOCK, self.spec.trees)):
                    now = self._with_block(cached, trees[first:], weights[first:])
                    # As in MLlib: the first tree counts in full, the later ones fit the gradient of the squared error.
                    residual = F.col(LABEL) if number == 0 else 2 * (F.col(LABEL) - F.col(SO_FAR))
                    trees.append(self._tree(now.select(VECTOR, residual.alias(RESIDUAL)), number))
                    weights.append(self.spec.rate if number else 1.0)
                errors += self._errors(held, trees[first:], weights[first:])
                train, held = (stage(self._with_block(df, trees[first:], weights[first:]), "boosting") for df in (cached, held))
            finally:
                cached.unpersist()
        best = self.best_length(errors)
        return self._ensemble(trees[:best], weights[:best])

    def _with_block(self, df: DataFrame, trees: Sequence[DecisionTreeRegressionModel], weights: Sequence[float]) -> DataFrame:
        if not trees:
            return df
        added = self._ensemble(trees, weights).transform(df)
        return added.select(VECTOR, LABEL, (F.col(SO_FAR) + F.col(RAW)).alias(SO_FAR))

    @staticmethod
    def _errors(held: DataFrame, trees: Sequence[DecisionTreeRegressionModel], weights: Sequence[float]) -> list[float]:
        """Mean squared error after each tree of a block, from one pass over the validation rows."""
        running, steps = F.col(SO_FAR), []
        for k, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
            held = tree.setFeaturesCol(VECTOR).setPredictionCol(f"_tree_{k}").transform(held)
            running = running + weight * F.col(f"_tree_{k}")
            steps.append(F.avg(F.pow(F.col(LABEL) - running, 2)).alias(f"e{k}"))
        return list(held.agg(*steps).first())

    def _fit_binned(self, df: DataFrame, validation: DataFrame, count: int) -> GBTRegressionModel:
        """The same boosting on binned rows; only the newest of their tables is kept, and none after the fit."""
        spark, width, bins, label = df.sparkSession, len(self.features), self.max_bins, self._label()
        trees, weights, errors = [], [], []
        ship(spark)
        with scratch(spark):
            cuts = histograms.feature_cuts(df, self.features, count, bins, self.spec.seed)
            place, held_place = fresh_folder(spark, "train-bins"), fresh_folder(spark, "validation-bins")
            train = stage(histograms.binned(df, self.features, label, cuts, bins, strict=True), folder=place)
            known = validation.filter(label.isNotNull())
            held = stage(histograms.binned(known, self.features, label, cuts, bins, strict=False), folder=held_place)
            while True:
                first = len(trees)
                for number in range(first, min(first + BLOCK, self.spec.trees)):
                    trees.append(histograms.grow(train, trees[first:], weights[first:], self.spec, number, width, bins))
                    weights.append(self.spec.rate if number else 1.0)
                block = trees[first:], weights[first:], width, bins
                errors += histograms.errors(held, *block)
                best = self.best_length(errors)
                if len(trees) >= self.spec.trees or len(trees) - best >= self.spec.patience:
                    break
                old, place, held_place = (place, held_place), fresh_folder(spark, "boosting"), fresh_folder(spark, "boosting")
                train = stage(histograms.advanced(train, *block), folder=place)
                held = stage(histograms.advanced(held, *block), folder=held_place)
                for folder in old:
                    remove(spark, folder)
        return self._ensemble([tree.model(cuts) for tree in trees[:best]], weights[:best])

    def best_length(self, errors: Sequence[float]) -> int:
        """Number of trees at the lowest error seen before ``patience`` trees without a lower one."""
        best = 0
        for i, error in enumerate(errors):
            if error < errors[best]:
                best = i
            elif i - best >= self.spec.patience:
                break
        return best + 1

    def fit(self, df: DataFrame, validation: DataFrame | None = None) -> "BoostedForecaster":
        missing = sorted(set(self.features) - set(df.columns))
        if missing:
            raise KeyError(f"missing feature columns: {missing[:5]}")
        shared_folder(df.sparkSession)  # where MLlib cuts the lineage of its tree iterations
        if validation is not None and not validation.isEmpty():
            count = df.count()
            if count > VECTOR_ROWS:
                self.model = self._fit_binned(df, validation, count)
                return self
        # Read once per tree, so held in the executors; lost blocks come back from the staged table.
        train = stage(self._prepare(df), "train-vectors")
        if validation is not None:
            held = stage(self._prepare(validation), "validation-vectors")
            if not held.isEmpty():
                self.model = self._fit_with_patience(train, held)
                return self
        train = train.persist()
        try:
            self.model = self._regressor(self.spec.trees).fit(train)
        finally:
            train.unpersist()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise NotFitted("fit the forecaster before using it")
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise KeyError(f"missing feature columns: {missing[:5]}")
        # The casts are folded into the assembler's input, which accepts any numeric type.
        raw = self.model.transform(self._assembler().transform(df))
        value = F.expm1(RAW) if self.log_target else F.col(RAW)
        kept = [c for c in df.columns if c != FORECAST]
        return raw.select(*kept, at_least(value, 0.0).alias(FORECAST))

    def importances(self, top: int = 20) -> DataFrame:
        """(position, feature, importance) of the top features, one row each."""
        if self.model is None:
            raise NotFitted("fit the forecaster first")
        spark = SparkSession.getActiveSession()
        ranked = sorted(zip(self.features, self.model.featureImportances.toArray()), key=lambda p: -p[1])[:top]
        rows = [(i + 1, name, float(v)) for i, (name, v) in enumerate(ranked)]
        return spark.createDataFrame(rows, "position int, feature string, importance double")

    def save(self, folder: str) -> None:
        if self.model is None:
            raise NotFitted("an unfitted forecaster cannot be saved")
        spark = SparkSession.getActiveSession()
        PipelineModel(stages=[self._assembler(), self.model]).write().overwrite().save(f"{folder}/model")
        facts = json.dumps(
            {
                "features": self.features,
                "target": self.target,
                "log_target": self.log_target,
                "max_bins": self.max_bins,
                "spec": asdict(self.spec),
            }
        )
        spark.createDataFrame([(facts,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/facts")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "BoostedForecaster":
        from pyspark.errors import AnalysisException

        try:
            facts = json.loads(spark.read.text(f"{folder}/facts").first().value)
        except AnalysisException as err:
            raise FileNotFoundError(f"no saved forecaster in {folder}") from err
        except (ValueError, AttributeError) as err:
            raise ModelFileError(f"unreadable facts in {folder}") from err
        if not isinstance(facts, dict):
            raise ModelFileError(f"unreadable facts in {folder}")
        lacking = {"features", "target", "log_target", "spec"} - set(facts)
        if lacking:
            raise ModelFileError(f"saved forecaster lacks {sorted(lacking)}")
        saved = PipelineModel.load(f"{folder}/model")
        if len(saved.stages) != 2 or not isinstance(saved.stages[1], GBTRegressionModel):
            raise ModelFileError(f"unexpected model kind in {folder}")
        if list(saved.stages[0].getInputCols()) != facts["features"]:
            raise ModelFileError(f"feature list and model differ in {folder}")
        out = cls(
            facts["features"],
            BoostSpec(**facts["spec"]),
            facts["target"],
            facts["log_target"],
            facts.get("max_bins", 64),
        )
        out.model = saved.stages[1]
        return out


def node_table(forecaster: BoostedForecaster) -> DataFrame:
    """The nodes of the fitted trees: ``tree, node, weight, value, feature, threshold, low, high``.

    ``value`` is the mean label of the training rows in the node. ``feature`` is -1 in a leaf; elsewhere rows with a
    value of at most ``threshold`` go on to the node ``low``, others and missing ones to ``high``.
    """
    if forecaster.model is None:
        raise NotFitted("fit the forecaster first")
    spark = SparkSession.getActiveSession()
    folder = fresh_folder(spark, "trees")
    forecaster.model.write().save(folder)
    weights = spark.createDataFrame(list(enumerate(map(float, forecaster.model.treeWeights))), "tree int, weight double")
    nodes = spark.read.parquet(f"{folder}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    return nodes.join(F.broadcast(weights), "tree").select(
        "tree",
        F.col("id").alias("node"),
        "weight",
        F.col("prediction").alias("value"),
        F.when(F.col("leftChild") >= 0, F.col("split.featureIndex")).otherwise(-1).alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("low"),
        F.col("rightChild").alias("high"),
    )


class TreeAttribution:
    """What each feature adds to the raw forecast of each row, along the paths that the row takes.

    In every tree a step from a node to its child changes the expected value; the change is put down to the feature
    that the node splits by. Those of a row add up to its raw forecast less ``base``, the weighted sum of the values of
    the roots. All rows are attributed, by SQL expressions over the nodes as arrays, which have a few numbers for
    each node: they grow with the model, not with the rows.
    """

    def __init__(self, forecaster: BoostedForecaster) -> None:
        self.forecaster = forecaster
        rows = node_table(forecaster).collect()  # the model: trees times two to the power of their depth at most
        rows.sort(key=lambda r: (r["tree"], r["node"]))
        place = {(r["tree"], r["node"]): i for i, r in enumerate(rows)}
        self.roots = [i for i, r in enumerate(rows) if r["node"] == 0]
        self.base = float(sum(rows[i]["weight"] * rows[i]["value"] for i in self.roots))
        self.feature = [r["feature"] for r in rows]
        self.threshold = [r["threshold"] if r["threshold"] is not None else 0.0 for r in rows]
        self.value = [r["weight"] * r["value"] for r in rows]
        self.low, self.high = ([place.get((r["tree"], r[c]), -1) for r in rows] for c in ("low", "high"))
        self.depth = max((t.depth for t in forecaster.model.trees), default=0)

    def parts(self) -> Column:
        """An array with the contribution of each feature, in the order of the forecaster's features."""
        feature, threshold, value, low, high = (F.lit(x) for x in (self.feature, self.threshold, self.value, self.low, self.high))
        missing = F.lit(float("nan"))  # greater than every threshold
        x = F.array(*[F.coalesce(F.col(f).cast("double"), missing) for f in self.forecaster.features])

        def step(state: Column, _: Column) -> Column:
            node = state["node"]
            at = F.get(feature, node)
            child = F.when(F.get(x, at) <= F.get(threshold, node), F.get(low, node)).otherwise(F.get(high, node))
            change = F.struct(at.alias("feature"), (F.get(value, child) - F.get(value, node)).alias("change"))
            further = F.struct(child.alias("node"), F.concat(state["path"], F.array(change)).alias("path"))
            return F.when(at < 0, state).otherwise(further)

        empty = F.array().cast("array<struct<feature:int,change:double>>")
        levels = F.sequence(F.lit(1), F.lit(max(1, self.depth)))
        paths = F.transform(
            F.lit(self.roots),
            lambda root: F.aggregate(levels, F.struct(root.alias("node"), empty.alias("path")), step, lambda s: s["path"]),
        )

        def total(steps: Column) -> Column:
            numbers = F.sequence(F.lit(0), F.lit(len(self.forecaster.features) - 1))
            return F.transform(
                numbers,
                lambda f: F.aggregate(steps, F.lit(0.0), lambda s, p: s + F.when(p["feature"] == f, p["change"]).otherwise(0.0)),
            )

        return F.element_at(F.transform(F.array(F.flatten(paths)), total), 1)

    def attribution(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``keys, feature, contribution`` for all rows and features."""
        names = F.array(*[F.lit(f) for f in self.forecaster.features])
        each = df.select(*keys, F.posexplode(self.parts()).alias("_at", "contribution"))
        return each.select(*keys, F.get(names, F.col("_at")).alias("feature"), "contribution")


def challenger_spec(champion: BoostSpec, iteration: int) -> BoostSpec:
    """More trees, smaller steps, another seed."""
    return replace(
        champion,
        trees=min(800, champion.trees + 100),
        rate=max(0.01, champion.rate * 0.9),
        seed=42 + iteration,
    )


def driver_attribution(
    forecaster: Forecaster,
    df: DataFrame,
    features: Sequence[str],
    key: str = "id",
    seed: int = 42,
    block_rows: int = 50_000,
) -> DataFrame:
    """(feature, wmape_change): how much worse the forecast gets when one feature is shuffled.

    Rows are dealt into blocks by hash, and inside a block every row takes the feature values of the next
    row in hash order, so no task orders the whole frame. One scoring pass covers all features.
    """
    features = list(features)
    blocks = F.greatest(F.ceil(df.agg(F.count(F.lit(1))).scalar() / F.lit(block_rows)), F.lit(1))
    block = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), blocks)
    ring = Window.partitionBy("_block").orderBy(F.xxhash64(F.col(key), F.lit(seed + 1)), key)
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = F.struct(*features)
    mixed = df.withColumn("_block", block).withColumn(
        "_other", F.coalesce(F.lead(values).over(ring), F.first(values).over(whole))
    )
    labels = F.explode(F.array(F.lit(""), *[F.lit(f) for f in features]))
    each = mixed.withColumn("_shuffled", labels)
    shown = {
        f: F.when(F.col("_shuffled") == f, F.col(f"_other.{f}")).otherwise(F.col(f)).alias(f) for f in features
    }
    scored = forecaster.transform(
        each.select("_shuffled", *[shown.get(c, F.col(c)) for c in df.columns])
    )
    errors = scored.groupBy("_shuffled").agg(scores.wmape(forecaster.target, FORECAST).alias("wmape"))
    # One row per feature and one for the untouched frame.
    base = F.max(F.when(F.col("_shuffled") == "", F.col("wmape"))).over(Window.partitionBy())
    return (
        errors.select(F.col("_shuffled").alias("feature"), (F.col("wmape") - base).alias("wmape_change"))
        .filter("feature <> ''")
        .orderBy(F.col("wmape_change").desc(), "feature")
    )
