"""Shared Spark plumbing of the operators: tables that cut lineage, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Where it is unset, a temporary one in local mode, and an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def settle(df: DataFrame, name: str) -> DataFrame:
    """df, computed once and read back from a table in the shared folder: lineage ends there."""
    at = f"{shared_folder(df.sparkSession)}/panelkiln/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def free(df: DataFrame, *names: str) -> tuple[str, ...]:
    """names, lengthened where a column of df has one of them (Spark compares names without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return tuple(out)


def partitions(spark: SparkSession, times: int = 1) -> int:
    return times * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def buckets(docs: DataFrame, times: int = 1, each: int = 32 << 20) -> int:
    """Groups of packed rows: at least `times` spark.sql.shuffle.partitions, and one for `each` bytes of text, so that a
    group's size does not grow with the data."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(partitions(docs.sparkSession, times), -(-total // each))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, root) of every id on an edge (a, b): root is the smallest id that links reach.

    Alternates the large-star and small-star steps; each is a min-aggregation with map-side combine and an
    equi-join, so a hub's edges are never gathered in one task (AQE splits a skewed join).
    """
    e = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        both = e.union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x"))
        e = settle(small.select("x.a", "x.b").filter("a <> b").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    # at rest every edge points at its component's smallest id
    return e.select(F.col("a").alias("id"), F.col("b").alias("root")).union(e.select("b", "b").distinct()).groupBy("id").agg(F.min("root").alias("root"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
