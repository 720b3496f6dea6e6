"""Rows appended in named batches, each of which counts once.

A batch is written under a name of its attempt, and a marker under the batch's name, made by exclusive creation, says
which attempt counts. So a job that died half-way leaves rows that nobody reads, a repeated batch changes nothing, and
of two writers of one batch one is refused.

Defined results: an empty store reads as no rows. A marker without content (its writer died between making and filling
it) does not count and is taken over by the next commit of the batch.
"""

from __future__ import annotations

import json
import uuid
from hashlib import sha256

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Batches:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _marker(self, batch: str) -> str:
        return f"{self.path}/commits/{sha256(batch.encode()).hexdigest()}"

    def _mark(self, batch: str, attempt: str) -> bool:
        fs, p = self._at(self._marker(batch))
        try:
            out = fs.create(p, fs.exists(p) and fs.getFileStatus(p).getLen() == 0)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
                return False
            raise
        out.write(bytearray(json.dumps({"batch": batch, "attempt": attempt}).encode()))
        out.close()
        return True

    def committed(self) -> dict[str, str]:
        """Attempt of each committed batch, one small marker a batch."""
        fs, p = self._at(f"{self.path}/commits")
        if not fs.exists(p):
            return {}
        rows = self.spark.read.text(f"{self.path}/commits").collect()
        return {x["batch"]: x["attempt"] for x in (json.loads(r.value) for r in rows if r.value)}

    def has(self, batch: str) -> bool:
        fs, p = self._at(self._marker(batch))
        return fs.exists(p) and fs.getFileStatus(p).getLen() > 0

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """False, and nothing read or written, where the batch is in; False too where another writer was first."""
        if self.has(batch):
            return False
        attempt = uuid.uuid4().hex
        rows.select(*(f.split()[0] for f in self.schema.split(", "))).write.parquet(f"{self.path}/data/{attempt}")
        return self._mark(batch, attempt)

    def read(self, batches: list[str] | None = None) -> DataFrame:
        """Rows of all committed batches, or of some, with the batch's name as `batch`."""
        found = {b: a for b, a in self.committed().items() if batches is None or b in batches}
        if not found:
            return self.spark.createDataFrame([], f"{self.schema}, batch string")
        rows = self.spark.read.schema(self.schema).parquet(*(f"{self.path}/data/{a}" for a in found.values()))
        names = self.spark.createDataFrame([(a, b) for b, a in found.items()], "attempt string, batch string")
        attempt = F.regexp_extract(F.col("_metadata.file_path"), r"/data/([0-9a-f]{32})/", 1)
        # one name for each batch
        return rows.withColumn("attempt", attempt).join(F.broadcast(names), "attempt").drop("attempt")
