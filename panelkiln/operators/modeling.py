"""Model fitting, scoring, storage and comparison on pyspark.ml."""

from __future__ import annotations

import json
import math
import time

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import settle
from . import ensemble
from .clean import align_to_model

#: Deep and slow, balanced, shallow and fast.
PRESETS = {
    "deep": {"maxDepth": 12, "stepSize": 0.01, "maxIter": 2000, "subsamplingRate": 0.8},
    "balanced": {"maxDepth": 10, "stepSize": 0.05, "maxIter": 2000, "subsamplingRate": 0.8},
    "fast": {"maxDepth": 8, "stepSize": 0.1, "maxIter": 2000, "subsamplingRate": 0.9},
}
FOREST = {"deep": {"maxDepth": 12, "numTrees": 100}, "balanced": {"maxDepth": 10, "numTrees": 50}, "fast": {"maxDepth": 8, "numTrees": 20}}


#: Loss of the validation error, and the model's class of the JVM.
LOSSES = {"gbt": ("squared", "regression.GBTRegressionModel"), "classifier": ("logistic", "classification.GBTClassificationModel")}


def estimator(kind: str, preset: str = "fast", label: str = "target", validation: str | None = None, **params):
    """gbt, forest or classifier. validation: a boolean column for Spark's own stop at the first small gain (fit has patience instead)."""
    common = {"featuresCol": "_features", "labelCol": label, "seed": 42}
    stop = {"validationIndicatorCol": validation, "validationTol": 1e-4} if validation and kind != "forest" else {}
    if kind == "forest":
        return RandomForestRegressor(**common, **(FOREST[preset] | params))
    return {"gbt": GBTRegressor, "classifier": GBTClassifier}[kind](**common, **stop, **(PRESETS[preset] | params))


def best_round(errors: list[float], patience: int) -> tuple[int, bool]:
    """(rounds to keep, whether training would have ended): the last round that improved before `patience` rounds did not."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def _cut(model, kind: str, rounds: int):
    """The first trees of a boosted model."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    trees, weights = java.trees(), java.treeWeights()
    kept = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    own = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        kept[i], own[i] = trees[i], weights[i]
    of = gateway.jvm.org.apache.spark.ml
    for part in LOSSES[kind][1].split("."):
        of = getattr(of, part)
    more = [model.numClasses] if kind == "classifier" else []
    return model._copyValues(type(model)(of(java.uid(), kept, own, model.numFeatures, *more)))


#: Rows below which training takes them one by one; columns beyond which rows hardly repeat; bins of a column, as Spark's
#: trees have; condensed rows aimed at, and the least parts of a cell.
FEW_ROWS, MOST_COLUMNS, BINS, CONDENSED, PARTS = 200_000, 16, 32, 100_000, 4


def condensed(rows: DataFrame, kind: str, label: str, held: DataFrame | None = None) -> list[DataFrame] | None:
    """rows, and held in the bins of rows, as (_features, label, _weight, _spread): those of equal binned features as one row with
    their mean label, their number and the variance of their labels; None where that saves little.

    A tree with BINS bins sees a column only by its bins, and a cell's sum and number of labels only, so its splits are those
    of the rows. A column of more values takes the nearest of its quantiles; Spark puts thresholds half way between
    neighbouring values, which is where a quantile's bin ends, so a fitted tree sends a row where it sent its bin. Classes
    are not averaged. Every cell is dealt at random into PARTS parts or more, which subsampling and bootstrap then draw.
    """
    v = vector_to_array("_features")
    first = rows.select(F.size(v).alias("n")).first()
    if first is None or first.n > MOST_COLUMNS:
        return None
    names = [f"_x{i}" for i in range(first.n)]
    apart = lambda d: d.select(F.col(label).cast("double").alias(label), *(v[i].alias(x) for i, x in enumerate(names)))
    wide = apart(rows)
    seen = wide.agg(F.count("*").alias("n"), *(F.approx_count_distinct(x, 0.02).alias(x) for x in names)).first()
    if seen.n < FEW_ROWS:
        return None
    many = [x for x in names if seen[x] > 0.9 * BINS]
    found = wide.approxQuantile(many, [(i + 0.5) / BINS for i in range(BINS)], 0.002) if many else []
    values = {x: sorted(set(f)) for x, f in zip(many, found, strict=True) if len(set(f)) > 1}

    def binned(d: DataFrame) -> DataFrame:
        for x, near in values.items():
            # a threshold itself goes left
            ends = [math.nextafter((a + b) / 2, math.inf) for a, b in zip(near[:-1], near[1:], strict=True)]
            d = Bucketizer(splits=[-math.inf, *ends, math.inf], inputCol=x, outputCol="_bin", handleInvalid="keep").transform(d)
            d = d.withColumn(x, F.element_at(F.array(*map(F.lit, [*near, math.nan])), F.col("_bin").cast("int") + 1)).drop("_bin")
        return d

    keys = [*names, label] if kind == "classifier" else names
    cells = binned(wide).agg(F.approx_count_distinct(F.struct(*keys))).first()[0]
    parts = min(max(PARTS, CONDENSED // cells), seen.n // (2 * cells))
    if parts < PARTS:
        return None

    def made(d: DataFrame, parts: int) -> DataFrame:
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).alias("_part")
        one = [F.lit(0.0).alias("_spread")] if kind == "classifier" else [F.avg(label).alias(label), F.var_pop(label).alias("_spread")]
        every = binned(d).select("*", part).groupBy(*keys, "_part").agg(F.count("*").cast("double").alias("_weight"), *one)
        return settle(every.select(array_to_vector(F.array(*names)).alias("_features"), label, "_weight", "_spread"), "condensed")

    return [made(wide, parts), *([] if held is None else [made(apart(held), 1)])]


def fitted(make, rows: DataFrame, weighted: bool):
    return (make.setWeightCol("_weight") if weighted else make).fit(rows)


def boost_with_patience(train: DataFrame, held: DataFrame, kind: str, preset: str = "fast", label: str = "target", patience: int = 50, store: bool = False, **params):
    """(model, errors): a boosted model cut at the round with the least error on held, and the error after every round.

    Training ends where `patience` rounds have not improved on the best one. It runs in stages of doubling length: the
    trees of a stage begin with those of the stage before (one seed, one order of rows), so the rounds kept are those
    that one run with a look at held after every tree would keep, at no more than twice its trees.
    """
    make = estimator(kind, preset, label, None, **params)
    most = make.getMaxIter()
    rounds = min(most, 2 * patience)
    small = condensed(train, kind, label, held) if params.get("lossType") != "absolute" and params.get("maxBins", BINS) == BINS else None
    if small or store:
        train, held = small or [settle(d.select("_features", label), "training") for d in (train, held)]
    spread = (held.agg(F.try_divide(F.sum(F.col("_weight") * F.col("_spread")), F.sum("_weight"))).first()[0] or 0.0) if small else 0.0
    while True:
        model = fitted(make.setMaxIter(rounds), train, small is not None)
        errors = model.evaluateEachIteration(held, LOSSES[kind][0]) if kind == "gbt" else model.evaluateEachIteration(held)
        errors = [e + spread for e in errors]
        kept, ended = best_round(errors, patience)
        if ended or rounds == most:
            return _cut(model, kind, kept), errors
        rounds = min(most, 2 * rounds)


def fit(df: DataFrame, features: list[str], kind: str = "gbt", preset: str = "fast", label: str = "target", scale: bool = False, validation: str | None = None, patience: int = 50, **params) -> PipelineModel:
    """A pipeline that assembles (and standardises) the features and fits; missing features are 0, rows without a label are left out.

    validation: a boolean column; a boosted model is then trained on the other rows, and on those its rounds are chosen.
    """
    df = align_to_model(df, [c for c in df.columns if c not in features], features).filter(F.col(label).isNotNull())
    made = "_raw" if scale else "_features"
    stages = [VectorAssembler(inputCols=features, outputCol=made, handleInvalid="keep")]
    stages += [StandardScaler(inputCol="_raw", outputCol="_features", withMean=True)] if scale else []
    if validation is None or kind == "forest":
        make, ready = estimator(kind, preset, label, None, **params), Pipeline(stages=stages).fit(df)
        rows = ready.transform(df)
        small = condensed(rows, kind, label) if params.get("lossType") != "absolute" and params.get("maxBins", BINS) == BINS else None
        return PipelineModel([*ready.stages, fitted(make, small[0] if small else rows, small is not None)])
    ready = Pipeline(stages=stages).fit(df.filter(~F.col(validation)))
    rows = ready.transform(df).select("_features", label, F.col(validation).alias("_held"))
    model, _ = boost_with_patience(rows.filter("not _held"), rows.filter("_held"), kind, preset, label, patience, store=True, **params)
    return PipelineModel([*ready.stages, model])


class MeanModel:
    """Predicts the training mean; every feature has importance 1."""

    def __init__(self, df: DataFrame, features: list[str], label: str = "target"):
        self.mean, self.features = float(df.agg(F.avg(label)).first()[0] or 0.0), features

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(self.mean))

    def importance(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(f, 1.0) for f in self.features], "feature string, importance double")


def importance(model: PipelineModel, features: list[str], spark: SparkSession) -> DataFrame:
    """(feature, importance) of a tree model."""
    return spark.createDataFrame(list(zip(features, map(float, model.stages[-1].featureImportances.toArray()), strict=True)), "feature string, importance double")


def score(model, df: DataFrame, features: list[str], key: str = "symbol", low: float | None = 0.05, high: float | None = 0.95) -> DataFrame:
    """(key, prediction): features by name, missing ones 0, predictions cut to [low, high]."""
    out = model.transform(align_to_model(df, [key], features)).select(key, F.col("prediction").cast("double").alias("prediction"))
    return out if low is None else out.withColumn("prediction", F.least(F.greatest("prediction", F.lit(low)), F.lit(high)))


REGISTRY = "model_id string, model_type string, path string, created double, features string, metrics string, feature_set string, version long"


class ModelRegistry:
    """Saved pipelines and a table about them; a later version of a row replaces it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        spark.createDataFrame([], REGISTRY).write.mode("ignore").parquet(f"{self.path}/registry")

    def _append(self, row: tuple) -> None:
        self.spark.createDataFrame([row], REGISTRY).write.mode("append").parquet(f"{self.path}/registry")

    def all(self) -> DataFrame:
        rows = self.spark.read.schema(REGISTRY).parquet(f"{self.path}/registry")
        return rows.groupBy("model_id").agg(F.max_by(F.struct(*(c for c in rows.columns if c != "model_id")), "version").alias("r")).select("model_id", "r.*")

    def register(self, model_id: str, model_type: str, model: PipelineModel, features: list[str], metrics: dict, created: float | None = None, feature_set: str | None = None) -> None:
        at = f"{self.path}/models/{model_id}"
        model.write().overwrite().save(at)
        self._append((model_id, model_type, at, float(created if created is not None else time.time()), json.dumps(features), json.dumps(metrics), feature_set, 0))

    def update_metrics(self, model_id: str, metrics: dict) -> None:
        r = self.all().filter(F.col("model_id") == model_id).first()
        self._append((r.model_id, r.model_type, r.path, r.created, r.features, json.dumps(json.loads(r.metrics) | metrics), r.feature_set, r.version + 1))

    def list(self, model_type: str | None = None, feature_set: str | None = None) -> DataFrame:
        """Registered models, newest first, with filters (None: no filter)."""
        rows = self.all()
        for c, v in (("model_type", model_type), ("feature_set", feature_set)):
            rows = rows if v is None else rows.filter(F.col(c) == v)
        return rows.orderBy(F.col("created").desc(), "model_id")

    def latest(self, model_type: str | None = None):
        rows = self.all() if model_type is None else self.all().filter(F.col("model_type") == model_type)
        return rows.orderBy(F.col("created").desc(), "model_id").first()

    def load(self, model_id: str) -> tuple[PipelineModel, list[str]]:
        r = self.all().filter(F.col("model_id") == model_id).first()
        if r is None:
            raise KeyError(model_id)
        return PipelineModel.load(r.path), json.loads(r.features)


def compare(df: DataFrame, candidates: dict[str, tuple[list[str], str, str]], keys: list[str], label: str = "target", folds: int = 3) -> DataFrame:
    """(model, rmse, mae, r2, sign_accuracy) over hash folds; candidates: name -> (features, kind, preset)."""
    marked, out = df.withColumn("_fold", F.pmod(F.xxhash64(*keys), F.lit(folds))), None
    for name, (features, kind, preset) in candidates.items():
        scored = None
        for k in range(folds):
            one = fit(marked.filter(F.col("_fold") != k), features, kind, preset, label).transform(marked.filter(F.col("_fold") == k)).select(label, "prediction")
            scored = one if scored is None else scored.unionByName(one)
        row = ensemble.regression_metrics(scored, label, "prediction").withColumn("model", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out
