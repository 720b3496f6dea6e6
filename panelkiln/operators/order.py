"""Distinct values with their rows, in ranges whose number grows with the values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import free, settle


def value_counts(df: DataFrame, column: str, most: int = 100_000) -> tuple[DataFrame, str]:
    """((column, n, part), part's name): rows of each distinct value, written once. Parts are ranges of about `most` values, in order
    from 0 (nulls first), so a part fits into one task, and all that is global has one row a part."""
    counts = settle(df.groupBy(column).agg(F.count("*").alias("n")), "counts")
    (part,) = free(counts, "part")
    parts = -(-counts.count() // most)
    if parts <= 1:
        return counts.withColumn(part, F.lit(0)), part
    return settle(counts.repartitionByRange(2 * parts, column).withColumn(part, F.spark_partition_id()), "ranges"), part
