"""Joins of feature sources, targets and live rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import PanelSpec


def join_targets(features: DataFrame, targets: DataFrame, on: str = "id") -> DataFrame:
    """Rows of both, by id."""
    extra = [c for c in targets.columns if c == on or c not in features.columns]
    return features.join(targets.select(extra), on, "inner")


def join_alternative(alternative: DataFrame, train: DataFrame, keys: list[str] | None = None, least_rows: int = 0) -> DataFrame:
    """Left join on keys, by default the first of (asset, date) and (symbol, date) that both have; raises if no target column
    arrives, or if least_rows is given and there are no more rows than that."""
    for keys in [keys] if keys else (["asset", "date"], ["symbol", "date"]):
        if all(k in alternative.columns and k in train.columns for k in keys):
            extra = [c for c in train.columns if c in keys or c not in alternative.columns]
            out = alternative.join(train.select(extra), keys, "left")
            if any(c.startswith("target") for c in out.columns) and (least_rows <= 0 or out.limit(least_rows + 1).count() > least_rows):
                return out
    raise ValueError("no pair of key columns gives a joined table with a target and enough rows")


def join_live(live: DataFrame, alternative: DataFrame) -> DataFrame:
    """Left join of the live universe on (asset, date), or asset = symbol where alternative has no asset."""
    own = alternative if "asset" in alternative.columns else alternative.withColumnRenamed("symbol", "asset")
    keys = ["asset", "date"] if "date" in live.columns and "date" in own.columns else ["asset"]
    return live.join(own.select(*keys, *(c for c in own.columns if c not in live.columns)), keys, "left")


def latest_rows(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows of each group's latest date; ties stay, and so does the date."""
    latest = df.groupBy(spec.group).agg(F.max(spec.order).alias("_latest"))  # combines map-side; a window would sort whole groups
    return df.join(latest.withColumnRenamed(spec.group, "_g"), F.col(spec.group).eqNullSafe(F.col("_g")) & (F.col(spec.order) == F.col("_latest")), "left_semi")


def group_statistics(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """{c}_{group}_mean and _std joined back to every row."""
    made = df.groupBy(F.col(group).alias("_group")).agg(*(x for c in columns for x in (F.avg(c).alias(f"{c}_{group}_mean"), F.stddev_samp(c).alias(f"{c}_{group}_std"))))
    # aggregates combine map-side, a window would sort whole groups
    return df.join(made, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")


def symbol_overlap(a: DataFrame, b: DataFrame, column: str = "symbol") -> DataFrame:
    """Distinct symbols of a that b has."""
    return a.select(column).distinct().join(b.select(column).distinct(), column, "left_semi")


def missing_symbols(wanted: DataFrame, live: DataFrame, column: str = "symbol") -> DataFrame:
    """Distinct wanted symbols that live does not have."""
    return wanted.select(column).distinct().join(live.select(column).distinct(), column, "left_anti")
