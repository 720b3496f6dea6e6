"""Ensembles, evaluation and output checks over long predictions (model, key, prediction)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import average_rank


def weighted_ensemble(predictions: DataFrame, weights: DataFrame | None = None, key: str = "symbol") -> DataFrame:
    """(key, prediction): weights normalised to 1, equal without a table; raises if models do not cover the same number of rows."""
    counts = [r.n for r in predictions.groupBy("model").agg(F.count("*").alias("n")).select("n").distinct().limit(2).collect()]
    if len(counts) > 1:
        raise ValueError("models have different numbers of predictions")
    if weights is None:
        return predictions.groupBy(key).agg(F.avg("prediction").alias("prediction"))
    both = predictions.join(weights.select("model", "weight"), "model")
    return both.groupBy(key).agg(F.try_divide(F.sum(F.col("weight") * F.col("prediction")), F.sum("weight")).alias("prediction"))


def inverse_error_weights(errors: DataFrame) -> DataFrame:
    """(model, weight) from (model, error): (1 / error) over their sum; one row a model."""
    inverse = F.try_divide(F.lit(1.0), F.col("error"))
    return errors.select("model", F.try_divide(inverse, F.sum(inverse).over(Window.partitionBy(F.lit(1)))).alias("weight"))


def regression_metrics(df: DataFrame, target: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """rmse, mae, r2 and sign_accuracy in one pass."""
    e, y = F.col(target) - F.col(prediction), F.when(F.col(prediction).isNotNull(), F.col(target))
    g = df.groupBy(*by) if by else df
    return g.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"), F.avg((F.signum(F.col(target)) == F.signum(F.col(prediction))).cast("double")).alias("sign_accuracy"))


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """accuracy, precision, recall, f1 at the threshold and the exact auc from average ranks."""
    ranked = average_rank(df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).select(F.col(label).cast("int").alias("_y"), F.col(score).cast("double").alias("_s")), "_s")
    hit = (F.col("_s") >= threshold).cast("int")
    total = lambda c: F.sum(c.cast("long"))
    one = ranked.agg(total(hit * F.col("_y")).alias("tp"), total(hit * (1 - F.col("_y"))).alias("fp"), total((1 - hit) * F.col("_y")).alias("fn"), total((1 - hit) * (1 - F.col("_y"))).alias("tn"), F.sum(F.when(F.col("_y") == 1, F.col("rank__s"))).alias("r"))
    p, n = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    precision, recall = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.try_divide(F.col("tp"), p)
    return one.select(F.try_divide(F.col("tp") + F.col("tn"), p + n).alias("accuracy"), precision.alias("precision"), recall.alias("recall"), F.try_divide(2 * precision * recall, precision + recall).alias("f1"), F.try_divide(F.col("r") - p * (p + 1) / 2, (p * n).cast("double")).alias("auc"))


def best_model(metrics: DataFrame) -> DataFrame:
    """The model of (model, rmse) with the lowest rmse."""
    return metrics.agg(F.min_by("model", F.struct("rmse", "model")).alias("model"), F.min("rmse").alias("rmse"))


def output_check(df: DataFrame, key: str = "symbol", prediction: str = "prediction") -> DataFrame:
    """One report row: rows, nulls, values outside [0, 1], repeated keys, ok. Missing columns raise."""
    lost = [c for c in (key, prediction) if c not in df.columns]
    if lost:
        raise ValueError(f"columns are missing: {lost}")
    bad = F.col(prediction).isNull() | F.isnan(prediction) | F.col(key).isNull()
    per = df.groupBy(key).agg(F.count("*").alias("n"), F.sum(bad.cast("long")).alias("nulls"), F.sum((~F.col(prediction).between(0, 1)).cast("long")).alias("outside"))
    one = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("nulls"), F.lit(0)).alias("n_null"), F.coalesce(F.sum("outside"), F.lit(0)).alias("n_outside"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_repeated"))
    return one.withColumn("ok", (F.col("n_null") == 0) & (F.col("n_outside") == 0) & (F.col("n_repeated") == 0))


def symbol_of(column: str = "id"):
    """The text before the first underscore."""
    return F.split_part(F.col(column), F.lit("_"), F.lit(1))
