"""A wide table as groups of columns, written apart and joined without a shuffle.

Each row gets a number when the table is begun; every group holds it beside its own columns and is bucketed by it into
the same number of buckets, so groups meet bucket by bucket. A group has at most MOST_COLUMNS columns: above 100
fields Spark leaves whole-stage code generation, and adjacent projections are merged into one, so only a write ends a
projection. A read touches the groups whose columns it names.

Defined results: rows are kept one for one, whatever their values. A column's name is in one group only; a second one
raises.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import folder, settle

MOST_COLUMNS = 80
ROW = "row_number_"


def batched(items: Iterable, size: int) -> Iterator[list]:
    """Lists of at most size items; the next item is asked for only when a list before it was taken."""
    held = []
    for x in items:
        held.append(x)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


class ColumnGroups:
    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.path = spark, (path or folder(spark, "columns")).rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        self.name, self.groups = f"columns_{uuid.uuid4().hex}", {}

    def _table(self, group: str) -> str:
        return f"{self.name}_{group}"

    def _write(self, group: str, df: DataFrame, columns: list[str]) -> None:
        known = {c for own in self.groups.values() for c in own}
        if again := known & set(columns):
            raise ValueError(f"columns are there already: {sorted(again)}")
        out = df.select(ROW, *(F.col(f"`{c}`") for c in columns)).write.bucketBy(self.buckets, ROW).sortBy(ROW)
        out.mode("overwrite").option("path", f"{self.path}/{group}").option("compression", "zstd").saveAsTable(self._table(group))
        self.groups[group] = list(columns)

    def begin(self, df: DataFrame) -> None:
        """The first group: the columns of df, with numbered rows, dealt into buckets."""
        rows = settle(df.withColumn(ROW, F.monotonically_increasing_id()), "begin")
        self._write("base", rows.repartition(self.buckets, ROW), df.columns)

    def columns(self) -> list[str]:
        return [c for own in self.groups.values() for c in own]

    def read(self, columns: Iterable[str] | None = None, with_row: bool = False) -> DataFrame:
        """These columns (default: all), of the groups that hold them only."""
        wanted = list(columns) if columns is not None else self.columns()
        need = [g for g, own in self.groups.items() if set(own) & set(wanted)] or ["base"]
        out = None
        for g in need:
            one = self.spark.table(self._table(g)).select(ROW, *(F.col(f"`{c}`") for c in self.groups[g] if c in set(wanted)))
            out = one if out is None else out.join(one, ROW)
        return out.select(*([ROW] if with_row else []), *(F.col(f"`{c}`") for c in wanted))

    def add(self, group: str, df: DataFrame, columns: list[str]) -> None:
        """Columns of df, a frame derived row by row from read(with_row=True); buckets stay where they are."""
        if columns:
            self._write(group, df, columns)

    def make(self, made: Iterable[tuple[str, Column]], sources: list[str], at_a_time: int = MOST_COLUMNS, prefix: str = "made") -> None:
        """New columns, at most at_a_time in one projection and one group; sources: the columns that they are made of."""
        for i, part in enumerate(batched(made, at_a_time)):
            df = self.read(sources, with_row=True).select(ROW, *(c.alias(n) for n, c in part))
            self.add(f"{prefix}{len(self.groups)}_{i}", df, [n for n, _ in part])

    def drop(self) -> None:
        """Forgets the tables and removes their files."""
        for g in self.groups:
            self.spark.sql(f"drop table if exists {self._table(g)}")
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self.groups = {}
