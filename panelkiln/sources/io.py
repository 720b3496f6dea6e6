"""Sources and sinks: scans, snapshots, feature-set catalogue, sidecars."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import PanelSpec


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, limit: int | None = None, schema: str | T.StructType | None = None) -> DataFrame:
    """Parquet, or CSV with a header where the path ends in .csv (give a schema; it is inferred otherwise)."""
    if path.endswith((".csv", ".csv.gz")):
        reader = spark.read.option("header", True)
        df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    else:
        df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    df = df.select(columns) if columns else df
    return df.limit(limit) if limit else df


def column_batches(df: DataFrame, keys: list[str], size: int = 500) -> Iterator[DataFrame]:
    """Projections of size feature columns with the keys; Parquet reads only those."""
    rest = [c for c in df.columns if c not in keys]
    for at in range(0, len(rest), size):
        yield df.select(*keys, *rest[at : at + size])


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, modified, round) of the files under a path; round: the largest r<digits> in the name."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    return rows.select("path", name.alias("name"), F.col("modificationTime").alias("modified"), round_column(name).alias("round"))


def round_column(name: Column) -> Column:
    """The largest r<digits> in a name; null without one."""
    return F.array_max(F.transform(F.regexp_extract_all(name, F.lit(r"r(\d+)"), F.lit(1)), lambda x: x.cast("long")))


def latest_file(spark: SparkSession, path: str, patterns: Iterable[str]) -> str | None:
    """The newest file of the first pattern (like r*_train.parquet, on the name) that matches any."""
    rows = files(spark, path)
    for p in patterns:
        r = rows.filter(F.col("name").rlike(f"^{fnmatch.translate(p)}")).agg(F.max_by("path", F.struct("modified", "path"))).first()[0]
        if r is not None:
            return r
    return None


def round_of(name: str) -> int | None:
    """The largest round in a file's name."""
    found = re.findall(r"r(\d+)", name)
    return max(map(int, found)) if found else None


def write_landing(df: DataFrame, path: str, snapshot: str) -> None:
    """Writes one point-in-time snapshot (YYYYMMDD) as its own partition folder."""
    if not re.fullmatch(r"\d{8}", snapshot):
        raise ValueError("a snapshot is named by eight digits")
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path.rstrip('/')}/snapshot_date={snapshot}")


def read_landing(spark: SparkSession, path: str, until: str) -> DataFrame:
    """All snapshots up to a date; later partitions are not read."""
    return spark.read.option("basePath", path).parquet(path).filter(F.col("snapshot_date") <= int(until))


class FeatureSets:
    """Named feature sets, one folder each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def names(self) -> list[str]:
        fs, p = self._fs(self.path)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def save(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{name}")

    def get(self, candidates: Iterable[str], symbols: list[str] | None = None) -> DataFrame:
        have = set(self.names())
        for n in candidates:
            if n in have:
                df = self.spark.read.parquet(f"{self.path}/{n}")
                return df.filter(F.col("symbol").isin(symbols)) if symbols else df
        raise KeyError(f"none of these feature sets exists: {list(candidates)}")

    def info(self, name: str, group: str = "symbol", order: str = "date") -> DataFrame:
        return describe(self.spark.read.parquet(f"{self.path}/{name}"), PanelSpec(group, order))


def describe(df: DataFrame, spec: PanelSpec, families: dict[str, str] | None = None) -> DataFrame:
    """One row: rows, symbols, first and last date, number of features, and per family the columns that match its pattern."""
    families = families or {"rolling": "_roll_", "lag": "_lag_", "ewm": "_ewm_"}
    names = spec.features(df)
    one = df.agg(F.count("*").alias("n_rows"), F.count_distinct(spec.group).alias("n_symbols"), F.min(spec.order).alias("first_date"), F.max(spec.order).alias("last_date"))
    return one.select("*", F.lit(len(names)).alias("n_features"), *(F.lit(sum(bool(re.search(p, c)) for c in names)).alias(f"n_{k}") for k, p in families.items()))


def write_splits(df: DataFrame, path: str, column: str = "split", compression: str = "zstd", group_rows: int = 100_000) -> None:
    """One folder for each value of the split column; row groups of at most group_rows rows, so readers skip and split finely."""
    df.write.mode("overwrite").option("compression", compression).option("parquet.block.row.count.limit", group_rows).partitionBy(column).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for outputs of a row per symbol."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_sidecar(df: DataFrame, spec: PanelSpec, path: str) -> None:
    describe(df, spec).coalesce(1).write.mode("overwrite").json(path)


def checkpoint(df: DataFrame, path: str, iteration: int) -> DataFrame:
    """Writes an iteration and reads it back, which ends the lineage."""
    at = f"{path.rstrip('/')}/iteration={iteration}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(at)
    return df.sparkSession.read.parquet(at)
