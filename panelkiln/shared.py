"""Tables in the folder that all executors share, where lineage ends."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new place under spark.checkpoint.dir (else the warehouse); a temporary folder in local mode only, an error on a cluster without either."""
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir") or conf.get("spark.sql.warehouse.dir")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = base or tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/panelkiln/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """df, computed once and read back."""
    at = folder(df.sparkSession, name)
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


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
