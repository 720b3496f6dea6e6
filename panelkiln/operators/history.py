"""Feature tracking: registered files and columns, new features, validity history, snapshots and deltas."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import settle
from ..sources.batches import Batches

FILES = "file_id string, path string, source string, snapshot_date string"
FEATURES = "feature string, source string, data_type string, file_id string, snapshot_date string, n_values long"
ESSENTIAL = {"alternative": ("symbol", "date"), "targets": ("id", "target", "data_type")}


class FeatureBook:
    """Registered files and features in committed batches: registering twice changes nothing, also from two writers at once, and a
    registration that died half-way is not seen."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._files, self._features = Batches(spark, f"{path.rstrip('/')}/files", FILES), Batches(spark, f"{path.rstrip('/')}/features", FEATURES)

    def files(self) -> DataFrame:
        return self._files.read().drop("batch")

    def features(self) -> DataFrame:
        """One row for each feature of each file."""
        keys = ["feature", "source", "file_id"]
        return self._features.read().groupBy(*keys).agg(F.min("data_type").alias("data_type"), F.min("snapshot_date").alias("snapshot_date"), F.max("n_values").alias("n_values"))

    def register_file(self, path: str, source: str, snapshot_date: str) -> str:
        """The file's id: a hash of its source, path and date."""
        key = sha256(f"{source}\n{path}\n{snapshot_date}".encode()).hexdigest()
        self._files.commit(key, self.spark.createDataFrame([(key, path, source, snapshot_date)], FILES))
        return key

    def register_features(self, file_id: str, df: DataFrame, source: str, snapshot_date: str) -> None:
        """The columns of df with their types and numbers of values (null and NaN are none), in one pass over df."""
        known = sha256(f"{file_id}\n{sorted(df.dtypes)}".encode()).hexdigest()
        if self._features.has(known):
            return
        present = [F.count(F.when(F.col(c).isNotNull() & (~F.isnan(c) if t in ("double", "float") else F.lit(True)), 1)).alias(f"n{i}") for i, (c, t) in enumerate((f"`{c}`", t) for c, t in df.dtypes)]
        rows = F.array(*(F.struct(F.lit(c).alias("feature"), F.lit(source).alias("source"), F.lit(t).alias("data_type"), F.lit(file_id).alias("file_id"), F.lit(snapshot_date).alias("snapshot_date"), F.col(f"n{i}").alias("n_values")) for i, (c, t) in enumerate(df.dtypes)))
        self._features.commit(known, df.agg(*present).select(F.explode(rows).alias("r")).select("r.*"))

    def new_columns(self, df: DataFrame, source: str) -> list[str]:
        """Essential columns and those no file of the source had; all for its first file."""
        seen = {r.feature for r in self.features().filter(F.col("source") == source).select("feature").distinct().collect()}
        return [c for c in df.columns if c in ESSENTIAL.get(source, ()) or c not in seen]

    def only_new(self, df: DataFrame, source: str) -> DataFrame:
        return df.select(self.new_columns(df, source))

    def counts(self) -> DataFrame:
        """(source, n_features, n_values): features registered, and values of all of them."""
        return self.features().groupBy("source").agg(F.count_distinct("feature").alias("n_features"), F.sum("n_values").alias("n_values"))

    def seen(self) -> DataFrame:
        """(source, feature, first_seen, last_seen, n_files, n_values): snapshots in which the feature has values."""
        return self.features().filter("n_values > 0").groupBy("source", "feature").agg(F.min("snapshot_date").alias("first_seen"), F.max("snapshot_date").alias("last_seen"), F.count("*").alias("n_files"), F.sum("n_values").alias("n_values"))


def melt(df: DataFrame, entity: str, time: str, columns: Iterable[str]) -> DataFrame:
    """(entity, feature, value string, valid_from) from a wide frame."""
    return df.select(F.col(entity).alias("entity"), F.col(time).alias("valid_from"), F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns))).alias("x")).select("entity", "x.feature", "x.value", "valid_from")


def validity_history(values: DataFrame, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """(entity, feature, value, valid_from, valid_to): a record where the value's hash changed, closed by the next one."""
    w = Window.partitionBy("entity", "feature").orderBy("valid_from", *tiebreak)
    h = F.xxhash64("value", F.col("value").isNull())
    marked = values.withColumn("_h", h).withColumn("_p", F.lag("_h").over(w)).withColumn("_n", F.row_number().over(w))
    kept = marked.filter((F.col("_n") == 1) | (F.col("_h") != F.col("_p")))
    return kept.select("entity", "feature", "value", "valid_from", F.lead("valid_from").over(w).alias("valid_to"))


RECORDS = "entity string, feature string, value string, valid_from timestamp, valid_to timestamp, bucket int, is_open boolean"


class ValidityStore:
    """A validity history kept up snapshot by snapshot.

    Open records are the state, dealt into buckets of (entity, feature). A snapshot reads the newest state of the buckets
    that it touches, and commits as one batch: the records that it closes, and the new state of those buckets. Nothing
    is rewritten in place: the state of a bucket is that of the last batch that touched it. A snapshot committed twice
    changes nothing, and one that died half-way is not seen. One writer at a time.

    Defined results: those of validity_history over all snapshots at once. A snapshot may hold many values of a key; none
    may be as old as the record that is open for its key, unless it repeats that record (ValueError).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.batches = Batches(spark, path, RECORDS)
        self.order = Batches(spark, f"{path.rstrip('/')}/order", "seq long, snapshot string, records string, buckets array<int>")

    def _taken(self) -> list:
        """Snapshots in the order in which they were taken in: one row each."""
        return sorted(self.order.read().collect(), key=lambda r: r.seq)

    def _state(self, touched: list[int]) -> DataFrame:
        latest = {b: r.records for r in self._taken() for b in set(r.buckets) & set(touched)}
        rows = self.batches.read(sorted(set(latest.values()))).filter("is_open")
        names = self.spark.createDataFrame([(b, s) for b, s in latest.items()] or [], "bucket int, batch string")
        return rows.join(F.broadcast(names), ["bucket", "batch"], "left_semi").drop("batch")  # one row a bucket

    def apply(self, snapshot: str, values: DataFrame) -> bool:
        """Takes (entity, feature, value, valid_from) in; False if the snapshot is in already."""
        if self.order.has(snapshot):
            return False
        bucket = F.pmod(F.xxhash64("entity", "feature"), F.lit(self.buckets)).cast("int").alias("bucket")
        new = settle(values.select(F.col("entity").cast("string").alias("entity"), "feature", F.col("value").cast("string").alias("value"), F.col("valid_from").cast("timestamp").alias("valid_from"), bucket), "snapshot")
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]
        state = self._state(touched).select("entity", "feature", "value", "valid_from", "bucket", F.lit(True).alias("known"))
        both = state.unionByName(new.withColumn("known", F.lit(False)))
        of_key = Window.partitionBy("entity", "feature")
        begins = F.max(F.when(F.col("known"), F.struct("valid_from", "value"))).over(of_key)
        late = both.select("known", "valid_from", "value", begins.alias("open")).filter(~F.col("known") & (F.col("valid_from") <= F.col("open.valid_from")) & ~((F.col("valid_from") == F.col("open.valid_from")) & F.col("value").eqNullSafe(F.col("open.value"))))
        if not late.isEmpty():
            raise ValueError("a snapshot's values must be newer than the records that they close")
        made = validity_history(both.drop("known"), ("value",)).withColumn("bucket", bucket).withColumn("is_open", F.col("valid_to").isNull())
        # the records count once the snapshot's row is in
        records, seq = f"{snapshot}-{uuid.uuid4().hex}", 1 + max((r.seq for r in self._taken()), default=0)
        self.batches.commit(records, made)
        return self.order.commit(snapshot, self.spark.createDataFrame([(seq, snapshot, records, touched)], self.order.schema))

    def history(self) -> DataFrame:
        """(entity, feature, value, valid_from, valid_to): all closed records, and the open ones."""
        closed = self.batches.read([r.records for r in self._taken()]).filter("not is_open").drop("batch")
        return closed.unionByName(self._state(list(range(self.buckets)))).drop("bucket", "is_open")


def as_of(history: DataFrame, when, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per entity with the values valid at `when`; columns lists the features to pivot (else they are looked up)."""
    t = F.lit(when).cast(history.schema["valid_from"].dataType)
    live = history.filter((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))
    return live.groupBy("entity").pivot("feature", list(columns) if columns else None).agg(F.max("value"))


def snapshot_series(history: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """(snapshot, entity, feature, value) at start, start + days, ... until end."""
    # a record is turned into the dates inside it, so no range join is needed
    step = F.expr(f"sequence(to_date('{start}'), to_date('{end}'), interval {int(days)} days)")
    inside = F.filter(step, lambda d: (d.cast("timestamp") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (d.cast("timestamp") < F.col("valid_to"))))
    return history.select(F.explode(inside).alias("snapshot"), "entity", "feature", "value")


def delta(history: DataFrame, a, b) -> DataFrame:
    """(entity, feature, old_value, new_value) that differ between two times, absent ones as null."""
    t = history.schema["valid_from"].dataType
    live = lambda x: (F.col("valid_from") <= F.lit(x).cast(t)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(x).cast(t)))
    # the history is read once: each side is the one record that was valid then
    both = history.filter(live(a) | live(b)).groupBy("entity", "feature").agg(*(F.max(F.when(live(x), F.struct("value"))).alias(n) for x, n in ((a, "old"), (b, "new"))))
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select("entity", "feature", F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value"))


def value_history(history: DataFrame, entity, feature: str) -> DataFrame:
    return history.filter((F.col("entity") == entity) & (F.col("feature") == feature)).orderBy("valid_from")

