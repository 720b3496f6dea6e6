"""Sorts, limits, top-k and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..spec import PanelSpec
from .clean import key_number
from .order import value_counts


def sorted_panel(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.orderBy(spec.group, spec.order, *spec.tiebreak)


def newest(df: DataFrame, column: str, limit: int, offset: int = 0, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """limit rows after offset, newest first."""
    out = df.orderBy(F.col(column).desc(), *tiebreak)
    return (out.offset(offset) if offset else out).limit(limit)


def top_k(df: DataFrame, column: str, k: int, within: str | None = None, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The k largest, of all or of each group."""
    if within is None:
        return df.orderBy(F.col(column).desc(), *tiebreak).limit(k)
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(within).orderBy(F.col(column).desc(), *tiebreak))).filter(F.col("rank") <= k)


def time_split(df: DataFrame, spec: PanelSpec, test_share: float = 0.2) -> DataFrame:
    """split 'train' for the first int(n * (1 - share)) rows by (order, tiebreak), else 'test'.

    Rows are counted per date, and dates in ranges, so no window holds all dates; in the date of the cut, rows are counted
    per group, and only the rows of one group are ranked.
    """
    counts, part = value_counts(df, spec.order)
    n = counts.agg(F.sum("n")).first()[0] or 0
    cut = int(n * (1 - test_share))
    at = _where(counts, part, spec.order, cut)
    if at is None:
        return df.withColumn("split", F.lit("train"))
    day, left = at
    group, more = _where(*value_counts(df.filter(F.col(spec.order) == F.lit(day)), spec.group), spec.group, left)
    order, own = F.col(spec.order), F.col(spec.group)
    early = (order < F.lit(day)) | (order == F.lit(day)) & (own < F.lit(group))
    here = (order == F.lit(day)) & own.eqNullSafe(F.lit(group))
    ranked = df.filter(here).select("*", F.row_number().over(Window.partitionBy(own).orderBy(*(spec.tiebreak or (spec.order,)))).alias("rank_in_cut"))
    split = ranked.withColumn("split", F.when(F.col("rank_in_cut") <= more, "train").otherwise("test")).drop("rank_in_cut")
    rest = df.filter(~F.coalesce(here, F.lit(False))).withColumn("split", F.when(early, "train").otherwise("test"))
    return rest.unionByName(split)


def _where(counts: DataFrame, part: str, column: str, cut: int):
    """(value, cut - rows before it) for the value of column, in order, whose n rows hold row number cut; None beyond the end.

    The driver sees one sum for each part, and only the part that holds the row is summed up in order.
    """
    for r in sorted(counts.groupBy(part).agg(F.sum("n").alias("n")).collect(), key=lambda r: r[part]):
        if cut < r.n:
            run = counts.filter(F.col(part) == r[part]).withColumn("before", F.sum("n").over(Window.partitionBy(part).orderBy(column)) - F.col("n"))
            at = run.filter((F.col("before") <= cut) & (F.col("before") + F.col("n") > cut)).first()
            return at[column], cut - at["before"]
        cut -= r.n
    return None


def hash_split(df: DataFrame, keys: list[str], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """split by a hash of the key: the same rows for any partitioning."""
    return df.withColumn("split", F.when(key_number(keys, seed) < F.lit(int(test_share * (1 << 52))), "test").otherwise("train"))
