"""Aggregates and column statistics. Null and NaN are missing throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import gram
from .clean import value


def _rows(one: DataFrame, fields: dict[str, list[str]], names: list[str]) -> DataFrame:
    """A one-row frame with {field}{i} columns as a row for each name."""
    return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("feature"), *(F.col(f"{f}{i}").alias(f) for f in fields)) for i, n in enumerate(names)))).alias("r")).select("r.*")


def group_summary(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """{c}_mean, _std, _max, _min per group."""
    return df.groupBy(group).agg(*(f(c).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max), ("min", F.min))))


def distinct_report(df: DataFrame, column: str, first: int = 10) -> DataFrame:
    """(n_rows, n_distinct, first values in order) of a column."""
    head = [r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(first).collect()]
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(column).alias("n_distinct")).withColumn("first_values", F.array(*(F.lit(x).cast("string") for x in head)))


def type_issues(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, n_null, is_numeric): features that a model could not read."""
    kinds = {f.name: isinstance(f.dataType, T.NumericType) for f in df.schema}
    one = df.agg(*(F.sum(F.col(c).isNull().cast("long")).alias(f"n_null{i}") for i, c in enumerate(columns))).select("*", *(F.lit(kinds[c]).alias(f"is_numeric{i}") for i, c in enumerate(columns)))
    return _rows(one, {"n_null": [], "is_numeric": []}, columns)


def variances(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, variance): sample variance of each column, one pass."""
    return _rows(df.agg(*(F.var_samp(value(F.col(c).cast("double"))).alias(f"variance{i}") for i, c in enumerate(columns))), {"variance": []}, columns)


def safe_corr(a: Column, b: Column) -> Column:
    """Correlation over pairs that are complete; null if either side is constant there."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def target_correlations(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(feature, corr): absolute correlation with the target, one pass."""
    t = value(F.col(target).cast("double"))
    return _rows(df.agg(*(F.abs(safe_corr(value(F.col(c).cast("double")), t)).alias(f"corr{i}") for i, c in enumerate(columns))), {"corr": []}, columns)


def correlation_matrix(df: DataFrame, columns: list[str]):
    """Full correlation matrix as a numpy array, each pair over the rows where both are present, in one pass (operators.gram); NaN
    where a side is constant there, 1 on the diagonal."""
    import numpy as np

    out = gram.correlation_matrix(df, columns)
    np.fill_diagonal(out, 1.0)
    return out


def overall_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """(mean, std): the columns' means and sample deviations, averaged over columns."""
    one = df.agg(*(F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)), *(F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)))
    mean = lambda p: sum((F.coalesce(F.col(f"{p}{i}"), F.lit(0.0)) for i in range(len(columns))), F.lit(0.0)) / len(columns)
    return one.select(mean("m").alias("mean"), mean("s").alias("std"))


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))


def merge_summary(inputs: dict[str, DataFrame], merged: DataFrame, column: str) -> DataFrame:
    """(source, n_rows, n_symbols, n_shared): rows and symbols of each input and the output, and symbols shared with the output."""
    own = merged.select(column).distinct()
    out = None
    for name, df in {**inputs, "merged": merged}.items():
        one = df.groupBy(column).agg(F.count("*").alias("n")).join(own.withColumn("_m", F.lit(1)), column, "left").agg(F.sum("n").alias("n_rows"), F.count(column).alias("n_symbols"), F.count("_m").alias("n_shared"))
        one = one.select(F.lit(name).alias("source"), "n_rows", "n_symbols", "n_shared")
        out = one if out is None else out.unionByName(one)
    return out
