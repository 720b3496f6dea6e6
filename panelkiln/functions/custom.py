"""User code: feature functions, generators, models and per-group maps."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.slices import join_group, numbered
from ..shared import free, settle
from ..spec import PanelSpec


class FeatureRegistry:
    """Named functions DataFrame -> DataFrame."""

    def __init__(self):
        self.functions: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def register(self, name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
        self.functions[name] = fn

    def apply(self, df: DataFrame, *names: str) -> DataFrame:
        for n in names or self.functions:
            df = df.transform(self.functions[n])
        return df


class Generator(Protocol):
    def generate_all_features(self, df: DataFrame, group_col: str, numeric_cols: list[str], date_col: str) -> DataFrame: ...


class Model(Protocol):
    """Any pyspark.ml Estimator has fit; its model has transform. A fitted model that weighs its features itself may have
    get_feature_importance() -> {feature: weight}."""

    def fit(self, df: DataFrame): ...


def generate(generator: Generator, df: DataFrame, spec) -> DataFrame:
    """A user's generator on a panel's columns; the keys must come back."""
    out = generator.generate_all_features(df, spec.group, spec.features(df), spec.order)
    return spec.check(out)


def fit_predict(model: Model, train: DataFrame, df: DataFrame) -> DataFrame:
    """df with the prediction of a user's model that was fitted on train."""
    out = model.fit(train).transform(df)
    if "prediction" not in out.columns:
        raise ValueError("the model's transform gives no prediction column")
    return out


def user_importance(fitted, df: DataFrame, features: list[str], label: str = "target", order: list[str] | None = None) -> DataFrame:
    """(feature, importance), one row for each of features: what the fitted user's model says itself, where it has
    get_feature_importance (features that it leaves out weigh 0); else by permutation, for any model with transform.

    Permutation: the growth of the mean squared error where one feature's values come from other rows. Rows are numbered
    range by range in the order of `order`, by default a hash of features and label, and each gets the values of the row
    half the table further on: one shuffle for all features. Rows without a label are left out; a feature that the
    model does not use weighs 0, and one that misleads it less than 0. An empty table gives nulls.
    """
    spark = df.sparkSession
    if hasattr(fitted, "get_feature_importance"):
        own = fitted.get_feature_importance()
        return spark.createDataFrame([(f, float(own.get(f, 0.0))) for f in features], "feature string, importance double")
    group, key, at, *other = free(df, "one_group", "row_hash", "place", *(f"other_{i}" for i in range(len(features))))
    rows = df.filter(F.col(label).isNotNull()).withColumn(group, F.lit(0)).withColumn(key, F.xxhash64(*features, label))
    by = order or [key]
    placed = settle(numbered(rows, PanelSpec(group, by[0], tuple(by[1:])), at).drop(group, key), "placed")
    n = max(placed.count(), 1)
    given = placed.select(F.pmod(F.col(at) + n // 2, F.lit(n)).alias(at), *(F.col(f).alias(o) for f, o in zip(features, other, strict=True)))
    both = settle(placed.join(given, at).drop(at), "dealt")
    error = lambda x: fitted.transform(x).agg(F.avg(F.pow(F.col("prediction") - F.col(label), 2))).first()[0]
    plain, found = error(both.drop(*other)), []
    for f, o in zip(features, other, strict=True):
        worse = error(both.withColumn(f, F.col(o)).drop(*other))
        found.append((f, None if plain is None else worse - plain))
    return spark.createDataFrame(found, "feature string, importance double")


def map_groups(df: DataFrame, group: str, fn: Callable, schema: str) -> DataFrame:
    """fn on each group as a pandas frame; a group must fit into one task's memory (else: map_groups_in_parts)."""
    return df.groupBy(group).applyInPandas(fn, schema)


def map_groups_in_parts(df: DataFrame, group: str, partial: Callable, merge: Callable, partial_schema: str, finish: Callable | None = None, schema: str | None = None, rows: int = 100_000, fan: int = 1_000) -> DataFrame:
    """A user's function over groups of any size, in two phases.

    partial: from a pandas frame of at most about `rows` rows of one group to a small frame; merge: from at most about
    `fan` such frames of one group, end to end, to one such frame, in any order and nesting; finish: from the merged
    frame to the result. Rows of a large group are dealt to parts by a hash of their place, so equal rows part too, and
    partial results are merged in as many levels as fan asks for.

    Defined results: a null group is a group. An empty table gives no rows.
    """
    n, part = free(df, "n_rows", "part")
    large = settle(df.groupBy(group).agg(F.count("*").alias(n)).filter(F.col(n) > rows), "large-groups")
    parts = F.coalesce(F.ceil(F.col(n) / rows), F.lit(1))
    dealt = join_group(df, large, [group], "left").withColumn(part, F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts)).drop(n)
    made = dealt.groupBy(group, part).applyInPandas(lambda key, pdf: partial(pdf.drop(columns=part)).assign(**{part: key[1]}), f"{partial_schema}, {part} long")
    most = -(-(large.agg(F.max(n)).first()[0] or 1) // rows)
    while most > fan:
        most = -(-most // fan)
        made = made.withColumn(part, F.pmod(F.col(part), F.lit(most)))
        made = made.groupBy(group, part).applyInPandas(lambda key, pdf: merge(pdf.drop(columns=part)).assign(**{part: key[1]}), f"{partial_schema}, {part} long")
    last = lambda pdf: (finish or (lambda x: x))(merge(pdf.drop(columns=part)))
    return made.groupBy(group).applyInPandas(last, schema or partial_schema)
