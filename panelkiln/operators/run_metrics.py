"""Run metrics as Parquet relations: appended versions, the latest wins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.batches import Batches

RELATIONS = {
    "runs": "run_id string, round long, timestamp timestamp, status string, metrics string",
    "models": "model_id string, run_id string, model_type string, timestamp timestamp, metrics string, parameters string",
    "features": "run_id string, timestamp timestamp, n_features long, method string",
    "feature_importance": "model_id string, feature_name string, importance double",
    "submissions": "submission_id string, run_id string, model_id string, timestamp timestamp, status string, metrics string",
}
KEYS = {"runs": ["run_id"], "models": ["model_id"], "features": ["run_id", "timestamp"], "feature_importance": ["model_id", "feature_name"], "submissions": ["submission_id"]}


class RunStore:
    """Reads and appends the five relations under a path; rows carry a version, the highest of a key counts.

    Each append is a batch that counts once: repeating it under its name changes nothing, and rows of an append that died
    half-way are not read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._of = {name: Batches(spark, f"{path.rstrip('/')}/{name}", schema + ", version long") for name, schema in RELATIONS.items()}

    def append(self, name: str, rows: DataFrame | list, version: int, batch: str | None = None) -> bool:
        """False if the batch is in already; without a name every append is a batch of its own."""
        df = rows if isinstance(rows, DataFrame) else self.spark.createDataFrame(rows, RELATIONS[name])
        return self._of[name].commit(batch or uuid.uuid4().hex, df.withColumn("version", F.lit(version).cast("long")))

    def append_model(self, row: tuple, importance: dict[str, float], version: int, batch: str | None = None) -> None:
        """A model and its importances; where the first was committed and the second not, a replay adds the second."""
        df = self.spark.createDataFrame([(row[0], importance)], "model_id string, m map<string,double>")
        self.append("models", [row], version, batch)
        self.append("feature_importance", df.select("model_id", F.explode("m").alias("feature_name", "importance")), version, batch)

    def read(self, name: str) -> DataFrame:
        df = self._of[name].read().drop("batch")
        rest = [c for c in df.columns if c not in KEYS[name]]
        # the highest version of a key, combined map-side; of equal versions the largest row
        return df.groupBy(*KEYS[name]).agg(F.max(F.struct("version", *(c for c in rest if c != "version"))).alias("r")).select(*(c if c in KEYS[name] else f"r.{c}" for c in df.columns if c != "version"))


def list_rows(df: DataFrame, limit: int, offset: int = 0, **equal) -> DataFrame:
    """Newest first, with filters column = value (None: no filter)."""
    for c, v in equal.items():
        df = df if v is None else df.filter(F.col(c) == v)
    out = df.orderBy(F.col("timestamp").desc(), df.columns[0])
    return (out.offset(offset) if offset else out).limit(limit)


def run_details(runs: DataFrame, models: DataFrame, features: DataFrame, submissions: DataFrame) -> DataFrame:
    """Each run with its models, features and submissions nested."""
    out = runs
    for name, child in (("models", models), ("features", features), ("submissions", submissions)):
        rows = child.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct(*(c for c in child.columns if c != "run_id")))).alias(name))
        out = out.join(rows, "run_id", "left")
    return out


def models_with_importance(models: DataFrame, importance: DataFrame) -> DataFrame:
    maps = importance.groupBy("model_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature_name", "importance")))).alias("importance"))
    return models.join(maps, "model_id", "left")


def metric_value(column: str, metric: str):
    """$.metric, else $.metrics.metric, of a JSON text."""
    return F.coalesce(F.get_json_object(column, f"$.{metric}"), F.get_json_object(column, f"$.metrics.{metric}")).try_cast("double")


def metric_history(df: DataFrame, metric: str, column: str = "metrics", time: str = "timestamp") -> DataFrame:
    return df.withColumn("value", metric_value(column, metric)).filter(F.col("value").isNotNull()).orderBy(time)


def feature_count_history(features: DataFrame) -> DataFrame:
    return features.select("run_id", "timestamp", "n_features").orderBy("timestamp", "run_id")


def importance_trend(importance: DataFrame, models: DataFrame, feature: str) -> DataFrame:
    return importance.filter(F.col("feature_name") == feature).join(models.select("model_id", "run_id", "timestamp"), "model_id").orderBy("timestamp", "model_id")


def run_report(models: DataFrame, features: DataFrame) -> DataFrame:
    """rmse, r2 and n_features of each model."""
    n = features.groupBy("run_id").agg(F.max_by("n_features", "timestamp").alias("n_features"))
    return models.select("run_id", "model_id", "model_type", metric_value("metrics", "rmse").alias("rmse"), metric_value("metrics", "r2").alias("r2")).join(n, "run_id", "left")
