"""Importance of a user's model, and row groups of the split sink."""

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from panelkiln.functions import custom
from panelkiln.sources import io


class Line:
    def transform(self, df):
        return df.withColumn("prediction", 3 * F.col("a") - F.col("b"))


def rows_of(spark, n=4000):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 3))
    return x, spark.createDataFrame([(*map(float, r), float(3 * r[0] - r[1]), i) for i, r in enumerate(x)], "a double, b double, c double, target double, place int").repartition(5)


def test_permutation_importance(spark):
    x, df = rows_of(spark)
    got = {r.feature: r.importance for r in custom.user_importance(Line(), df, ["a", "b", "c"]).collect()}
    # two independent draws differ by twice the variance
    assert abs(got["a"] / (18 * x[:, 0].var()) - 1) < 0.1 and abs(got["b"] / (2 * x[:, 1].var()) - 1) < 0.1 and abs(got["c"]) < 1e-9
    again = {r.feature: r.importance for r in custom.user_importance(Line(), df.repartition(2), ["a", "b", "c"]).collect()}
    assert all(abs(again[f] - got[f]) < 1e-9 for f in got)  # whatever the order of rows
    exact = {r.feature: r.importance for r in custom.user_importance(Line(), df, ["a", "b"], order=["place"]).collect()}
    for i, (f, c) in enumerate((("a", 3), ("b", 1))):
        assert abs(exact[f] - np.mean((c * (np.roll(x[:, i], 2000) - x[:, i])) ** 2)) < 1e-9
    assert [r.importance for r in custom.user_importance(Line(), df.limit(0), ["a"]).collect()] == [None]
    assert [r.importance for r in custom.user_importance(Line(), df.withColumn("target", F.lit(None).cast("double")), ["a"]).collect()] == [None]


def test_a_model_that_weighs_its_features_itself(spark):
    model = type("Own", (Line,), {"get_feature_importance": lambda self: {"a": 2}})()
    assert [tuple(r) for r in custom.user_importance(model, rows_of(spark, 5)[1], ["a", "b"]).collect()] == [("a", 2.0), ("b", 0.0)]


def test_row_groups_of_the_split_sink(spark, tmp_path):
    df = spark.range(25_000).select("id", F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split")).coalesce(1)
    io.write_splits(df, str(tmp_path / "s"), group_rows=3_000)
    sizes = [f.row_group(i).num_rows for p in (tmp_path / "s").rglob("*.parquet") for f in [pq.ParquetFile(p).metadata] for i in range(f.num_row_groups)]
    assert sum(sizes) == 25_000 and max(sizes) <= 3_000 and len(sizes) == 2 + 7
