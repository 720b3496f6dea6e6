"""Operators for groups and tables of any size: equal to the plain ones, and spread over tasks."""

import datetime
import math
import re
from dataclasses import replace
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelkiln.functions import custom
from panelkiln.operators import gram, history, modeling, order, run_metrics, scan, selection, slices, split, stats, windows
from panelkiln.shared import folder
from panelkiln.sources.batches import Batches
from panelkiln.sources.column_groups import ROW, ColumnGroups, batched
from panelkiln.spec import PanelSpec

SPEC = PanelSpec("symbol", "date", ("k",))


def hot(size):
    return PanelSpec("symbol", "date", ("k",), slice_rows=size)


@pytest.fixture(scope="module")
def frame():
    """One symbol holds more than half of the rows; another has no name; columns of the user have the operators' names."""
    rng, rows = np.random.default_rng(0), []
    for s, n in (("A", 1), ("B", 5), ("hot", 400), (None, 120), ("D", 90), ("gaps", 40)):
        for i in range(n):
            gone = i % 7 == 3 or s == "gaps" and 5 < i < 33
            rows.append((s, datetime.date(2024, 1, 1) + datetime.timedelta(days=i // 3), len(rows), None if gone else float(rng.normal(100, 5)), 1.0, 2.0, 3.0, 4.0))
    return pd.DataFrame(rows, columns=["symbol", "date", "k", "x", "slice", "own", "place", "at"])


@pytest.fixture(scope="module")
def panel(spark, frame):
    data = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in frame.itertuples(index=False)]
    return spark.createDataFrame(data, "symbol string, date date, k long, x double, slice double, own double, place double, at double").repartition(5)


def by_key(df):
    assert len(set(df.columns)) == len(df.columns)
    return {r.k: tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect()}


OPERATORS = {
    "rolling": lambda d, s: windows.rolling(d, s, ["x"], [3, 20]),
    "full": lambda d, s: windows.rolling(d, s, ["x"], [5], min_periods=None, ddof=0),
    "lags": lambda d, s: windows.lags(d, s, ["x", "k"], (1, 7)),
    "leads": lambda d, s: windows.leads(d, s, "x"),
    "returns": lambda d, s: windows.returns(d, s, "x"),
    "distances": lambda d, s: windows.distances(d, s, "x", 6),
    "momentum": lambda d, s: windows.momentum(d, s, "x", 4),
    "rsi": lambda d, s: windows.rsi(d, s, "x", 5),
    "bollinger": lambda d, s: windows.bollinger(d, s, "x", 8),
    "volume": lambda d, s: windows.volume_features(d, s, "x", 5),
    "generate": lambda d, s: windows.generate(d, s, iter(["x"]), [3, 9], [1, 4]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_windows_over_slices(panel, name):
    want = by_key(OPERATORS[name](panel, SPEC))
    for size in (2, 30, 1000):
        assert by_key(OPERATORS[name](panel, hot(size))) == want, size


def test_sums_and_means_over_slices(panel):
    for op in (lambda d, s: windows.on_balance_volume(d, s, "x", "k"), lambda d, s: windows.ewm_mean(d, s, "x", 5), lambda d, s: windows.ewm_std(d, s, "x", 5), lambda d, s: windows.macd(d, s, "x"), lambda d, s: windows.technical(d, s, "x", "k")):
        want, got = by_key(op(panel, SPEC)), by_key(op(panel, hot(30)))
        assert want.keys() == got.keys()
        for k in want:
            for a, b in zip(got[k], want[k], strict=True):
                assert a == b or isinstance(a, float) and a == pytest.approx(b, rel=1e-7, abs=1e-7), k


@pytest.mark.parametrize("size", [None, 7, 64])
def test_recursive_means_with_gaps(panel, frame, size):
    """As pandas has them: the next value after a gap weighs the mean less."""
    df = windows.ema(windows.ema(panel, hot(size), "x", 12), hot(size), "x", 3)
    got = pd.DataFrame([(r.k, r.x_ema_12, r.x_ema_3) for r in df.collect()], columns=["k", "a", "b"]).set_index("k").sort_index().astype(float)
    for column, span in (("a", 12), ("b", 3)):
        want = frame.groupby(frame.symbol.fillna("none")).x.transform(lambda v: v.ewm(span=span, adjust=False).mean())
        np.testing.assert_allclose(got[column].to_numpy(), want.to_numpy(), rtol=1e-9)


def test_maps_compose():
    rng = np.random.default_rng(1)
    a, b, start = rng.uniform(0, 1, 500), rng.normal(size=500), rng.random(500) < 0.02
    start[0] = True
    e, want = 0.0, []
    for x, y, s in zip(a, b, start, strict=True):
        e = x * (0.7 if s else e) + y
        want.append(e)
    big, small = scan.compose(start, a, b)
    np.testing.assert_allclose(big * 0.7 + small, want, rtol=1e-12)


def test_a_hot_group_spreads(spark, panel):
    both, cut, own = slices.sliced(panel, hot(25), 5)
    rows = both.filter("symbol = 'hot'").groupBy(cut.slice).agg(F.count("*").alias("n"), F.sum(F.col(own).cast("int")).alias("m")).collect()
    assert len(rows) == 16 and all(r.m == 25 and r.n <= 30 for r in rows)
    plan = windows.rolling(panel, hot(25), ["x"], [5])._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Window \[.*?\], \[(.*?)\], \[date", plan) and all("," in x for x in re.findall(r"Window \[.*?\], \[(.*?)\], \[date", plan))
    assert windows.rolling(panel.limit(0), hot(25), ["x"], [5]).collect() == []


def test_indicators_share_one_slicing(spark, panel):
    """Bounded frames write no table of rows and shuffle the rows once; dates of many rows are cut by the tiebreak."""
    at = Path(folder(spark, "x")).parent
    numbered = lambda: len(list(at.glob("numbered-*")))
    had = numbered()
    day = panel.select("symbol", F.when(F.col("k") % 50 > 0, F.lit(datetime.date(2024, 1, 1))).alias("date"), F.when(F.col("k") % 40 > 0, F.col("k")).alias("t"), "k", "x", "slice")
    for df, plain in ((panel, SPEC), (day, PanelSpec("symbol", "date", ("t", "k")))):
        steps = (windows.rsi, "x", 5), (windows.bollinger, "x", 8), (windows.leads, "x"), (windows.momentum, "x", 4)
        want = by_key(slices.together(df, plain, *steps))
        for size in (2, 30):
            got = slices.together(df, replace(plain, slice_rows=size), *steps)
            assert by_key(got) == want
            assert got._jdf.queryExecution().optimizedPlan().toString().count("Window [") >= 3 and len(re.findall(r"Exchange hashpartitioning\(", got._jdf.queryExecution().sparkPlan().toString() + got._jdf.queryExecution().executedPlan().toString())) <= 2
    both, cut, own = slices.dealt(day, replace(plain, slice_rows=30), 5)
    rows = both.filter("symbol = 'hot'").groupBy(cut.slice).agg(F.count("*").alias("n"), F.sum(F.col(own).cast("int")).alias("m")).collect()
    assert len(rows) > 8 and sum(r.m for r in rows) == 400 and max(r.n for r in rows) < 60
    assert numbered() == had


# correlations


def test_correlations_with_gaps(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 7)) @ rng.normal(size=(7, 7)) + 1e6
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 5] = 4.0
    x[2:, 6] = np.nan
    names = [f"c {i}" for i in range(7)]
    df = spark.createDataFrame([tuple(None if i % 3 == 0 and math.isnan(v) else float(v) for i, v in enumerate(r)) for r in x], ", ".join(f"`{n}` double" for n in names)).repartition(6)
    df = df.toDF(*(f"c{i}" for i in range(7)))
    want = pd.DataFrame(x).corr(min_periods=2).to_numpy().copy()
    want[5, :] = want[:, 5] = np.nan
    for tile in (2, 3, 512):
        got = gram.correlation_matrix(df, df.columns, tile)
        pairs = ~np.eye(7, dtype=bool)
        np.testing.assert_allclose(got[pairs], want[pairs], rtol=1e-7, atol=1e-9)
    assert np.isnan(gram.correlation_matrix(df.limit(0), df.columns)).all()


def test_a_thousand_columns_in_one_pass(spark, tmp_path):
    """Every tenth column repeats the one before it, with gaps."""
    n, rng = 1000, np.random.default_rng(4)
    x = rng.uniform(size=(400, n))
    x[:, 9::10] = x[:, 8::10] + rng.uniform(size=(400, n // 10)) * 0.01
    x[:, ::3][rng.random((400, len(range(0, n, 3)))) < 0.05] = np.nan
    pd.DataFrame(x, columns=[f"c{i}" for i in range(n)]).to_parquet(tmp_path / "wide.parquet", row_group_size=100)
    df = spark.read.parquet(str(tmp_path / "wide.parquet"))
    tracker, group = spark.sparkContext.statusTracker(), "gram"
    spark.sparkContext.setJobGroup(group, group)
    r = gram.correlation_matrix(df, df.columns, 256)
    spark.sparkContext.setJobGroup("other", "other")
    assert len(tracker.getJobIdsForGroup(group)) <= 14  # the shifts, then one scan whose ten tiles are read one by one
    np.testing.assert_allclose(r, df.toPandas().corr(min_periods=2).to_numpy(), atol=1e-9)
    assert selection.uncorrelated(df, df.columns) == [c for i, c in enumerate(df.columns) if i % 10 != 9]


# boosting


def test_best_round():
    assert modeling.best_round([5, 4, 3, 3.5, 3.4, 3.3], 3) == (3, True)
    assert modeling.best_round([5, 4, 3, 3.5, 3.4, 2.9, 9, 9], 3) == (6, False)
    assert modeling.best_round([1.0], 3) == (1, False)


def test_patience(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (600, 2))
    y = np.sin(4 * x[:, 0]) * np.sign(x[:, 1]) + rng.normal(0, 0.3, 600)
    df = spark.createDataFrame([(float(a), float(b), float(t), i % 3 == 0) for i, ((a, b), t) in enumerate(zip(x, y, strict=True))], "a double, b double, target double, valid boolean").coalesce(2)
    model = modeling.fit(df, ["a", "b"], "gbt", "fast", validation="valid", patience=2, maxDepth=3, stepSize=0.4)
    ready = model.stages[0].transform(df)
    one, errors = modeling.boost_with_patience(ready.filter("not valid"), ready.filter("valid"), "gbt", "fast", "target", 2, maxDepth=3, stepSize=0.4)
    kept, ended = modeling.best_round(errors, 2)
    assert ended and 1 < kept < len(errors) and len(one.trees) == kept and one.numFeatures == 2
    scored = one.transform(ready.filter("valid")).select(((F.col("target") - F.col("prediction")) ** 2).alias("e"))
    assert scored.agg(F.avg("e")).first()[0] == pytest.approx(errors[kept - 1]) and len(model.stages[-1].trees) > 1
    held = model.transform(df.filter("valid")).select("target", "prediction").toPandas()
    error = ((held.target - held.prediction) ** 2).mean()
    assert error < 0.5 * held.target.var()
    # the trees of a longer run begin with those of a shorter one
    short = modeling.estimator("gbt", "fast", maxIter=4, maxDepth=3, stepSize=0.4).fit(ready.filter("not valid"))
    assert short.evaluateEachIteration(ready.filter("valid"), "squared") == pytest.approx(errors[:4])


def test_training_rows_are_condensed(spark, monkeypatch):
    """Trees grow on few weighted rows that stand for all; errors and scores are those of the rows themselves."""
    monkeypatch.setattr(modeling, "FEW_ROWS", 1000)
    monkeypatch.setattr(modeling, "CONDENSED", 600)
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 3, 6000), rng.normal(size=6000)
    y = np.where(a == 1, 3.0, 0.0) + np.sin(2 * b) + rng.normal(0, 0.3, 6000)
    df = spark.createDataFrame([(float(p), float(q), float(t), float(t > 1), i % 4 == 0) for i, (p, q, t) in enumerate(zip(a, b, y, strict=True))], "a double, b double, target double, y double, valid boolean").repartition(3)
    trained = []
    plain = modeling.fitted
    monkeypatch.setattr(modeling, "fitted", lambda make, rows, weighted: trained.append((rows, weighted)) or plain(make, rows, weighted))
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="_features").transform(df)
    for kind, label in (("gbt", "target"), ("classifier", "y")):
        trained.clear()
        model, errors = modeling.boost_with_patience(ready.filter("not valid"), ready.filter("valid"), kind, "fast", label, 2, maxDepth=3, stepSize=0.4)
        rows, weighted = trained[0]
        assert weighted and rows.count() <= 4500 / 2
        n, total = rows.agg(F.sum("_weight"), F.sum(F.col("_weight") * F.col(label))).first()
        assert n == 4500 and total == pytest.approx(df.filter("not valid").agg(F.sum(label)).first()[0])
        held = ready.filter("valid").select(F.col("_features").alias("features"), F.col(label).alias("label"))
        own = model.evaluateEachIteration(held, "squared") if kind == "gbt" else model.evaluateEachIteration(held)
        assert errors[: len(own)] == pytest.approx(own, rel=1e-9) and len(own) > 1
    for columns in (["a"], ["a", "b"]):
        trained.clear()
        scored = modeling.fit(df, columns, "forest", "fast", maxDepth=5).transform(df).select("a", "target", "prediction").toPandas()
        assert trained[0][1] and trained[0][0].count() <= 3000
        seen = scored.groupby("a").mean()
        np.testing.assert_allclose(seen.prediction, seen.target, atol=0.15 if columns == ["a"] else 0.4)


# batches


def test_batches(spark, tmp_path):
    store = Batches(spark, str(tmp_path), "a long, b string")
    assert store.read().collect() == []
    one, two = spark.createDataFrame([(1, "x")], "a long, b string"), spark.createDataFrame([(2, "y")], "a long, b string")
    assert store.commit("one/with:odd name", one) and not store.commit("one/with:odd name", two)
    two.write.parquet(f"{tmp_path}/data/{'0' * 32}")  # a batch whose writer died before its marker
    assert [(r.a, r.b, r.batch) for r in store.read().collect()] == [(1, "x", "one/with:odd name")]
    open(store._marker("two"), "w").close()  # one that died between making its marker and filling it
    assert not store.has("two") and store.commit("two", two) and sorted(r.a for r in store.read().collect()) == [1, 2]
    assert [r.a for r in store.read(["two"]).collect()] == [2]
    # of two writers, both of which saw no marker, one is refused
    assert store._mark("three", "a" * 32) and not store._mark("three", "b" * 32)


def test_run_store_replays(spark, tmp_path):
    store = run_metrics.RunStore(spark, str(tmp_path))
    row = ("m1", "r1", "gbt", datetime.datetime(2024, 1, 1), "{}", "{}")
    for _ in range(2):
        store.append_model(row, {"f1": 1.0}, 1, batch="first")
    store.append("models", [(*row[:4], '{"rmse": 1}', "{}")], 2)
    assert [r.metrics for r in store.read("models").collect()] == ['{"rmse": 1}']
    assert store._of["models"].read().count() == 2 and store.read("feature_importance").count() == 1


# column groups


def test_three_thousand_columns(spark):
    df = spark.range(300).select("id", *(F.rand(i).alias(f"x{i}") for i in range(3)))
    store = ColumnGroups(spark, buckets=2)
    store.begin(df)
    made = ((f"f{i}", F.col(f"x{i % 3}") * (i + 1) + F.col("x0")) for i in range(3000))
    store.make(made, ["x0", "x1", "x2"])
    assert len(store.columns()) == 3004 and max(map(len, store.groups.values())) <= 80
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        read = store.read(["id", "f0", "f1500", "f2999"])
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("FileScan parquet") == 4
        made = store.read(["x0", "x1"], with_row=True).select(ROW, *(F.col(f"x{i % 2}") * i for i in range(80)))
        assert "*(1) Project" in made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    want = {r.id: (r.x0 + r.x0, r.x0 * 1501 + r.x0, r.x2 * 3000 + r.x0) for r in store.read(["id", "x0", "x1", "x2"]).collect()}
    got = {r.id: (r.f0, r.f1500, r.f2999) for r in read.collect()}
    assert got.keys() == want.keys() and len(want) == 300 and all(got[k] == pytest.approx(want[k]) for k in want)
    with pytest.raises(ValueError):
        store.add("again", store.read(["f0"], with_row=True), ["f0"])
    store.drop()


def test_evolution_in_batches(spark):
    taken, items = [], iter(range(10))
    for part in batched((taken.append(i) or i for i in items), 4):
        assert len(taken) <= 4 * (1 + part[0] // 4)  # nothing of a later batch is made
    df = spark.range(200).select("id", *(F.rand(i).alias(f"x{i}") for i in range(6))).withColumn("target", F.col("x0") * F.col("x1") + F.col("x2"))
    store = ColumnGroups(spark, buckets=2)
    store.begin(df)
    columns = [f"x{i}" for i in range(6)]
    kept, done = selection.evolve_in_batches(store, columns, "target", 2, batch=8, pairs=6, squares=6, drop=0.5)
    assert [d["generated"] for d in done[:5]] == [8, 8, 8, 8, 4] and max(d["width"] for d in done) <= 1 + 6 + 1 + 8 + len(kept)
    assert "x0_mul_x1" in kept and set(kept) <= set(store.columns()) and store.read(kept).count() == 200
    store.drop()


# history


def test_history_in_snapshots(spark, tmp_path):
    at = lambda d, h=0: datetime.datetime(2024, 1, d, h)
    first = [("a", "f", "1", at(1)), ("a", "f", "1", at(2)), ("b", "f", None, at(1)), ("b", "g", "x", at(3)), ("c", "f", "5", at(2)), ("c", "f", "6", at(2, 1))]
    second = [("a", "f", "2", at(5)), ("b", "f", None, at(5)), ("b", "g", "y", at(6)), ("b", "g", "x", at(7)), ("d", "f", "1", at(5))]
    third = [("a", "f", "2", at(9)), ("d", "f", None, at(9))]
    schema = "entity string, feature string, value string, valid_from timestamp"
    store, rows = history.ValidityStore(spark, str(tmp_path), buckets=4), []
    assert store.history().collect() == []
    for name, values in (("one", first), ("two", second), ("three", third)):
        df, rows = spark.createDataFrame(values, schema), rows + values
        # a writer that died before its snapshot counted
        store.batches.commit(f"{name}-dead", spark.createDataFrame([("z", "z", "z", at(1), None, 0, True)], history.RECORDS))
        assert store.apply(name, df) and not store.apply(name, df)
        want = history.validity_history(spark.createDataFrame(rows, schema), ("value",))
        assert sorted(map(tuple, store.history().collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    touched = {r.snapshot: set(r.buckets) for r in store.order.read().collect()}
    assert touched["three"] < touched["one"] | touched["two"]
    with pytest.raises(ValueError):
        store.apply("late", spark.createDataFrame([("a", "f", "3", at(4))], schema))


# two-phase maps, ranks, splits


def test_map_groups_in_parts(spark):
    df = spark.createDataFrame([("hot" if i % 3 else ("cold" if i % 2 else None), float(i % 50)) for i in range(3000)], "g string, x double").repartition(3)
    most = 200

    def partial(pdf):
        assert len(pdf) <= 3 * most
        return pd.DataFrame({"g": pdf.g[:1].to_numpy(), "n": [len(pdf)], "total": [pdf.x.sum()]})

    def merge(pdf):
        assert len(pdf) <= 9
        return pd.DataFrame({"g": pdf.g[:1].to_numpy(), "n": [pdf.n.sum()], "total": [pdf.total.sum()]})

    got = custom.map_groups_in_parts(df, "g", partial, merge, "g string, n long, total double", rows=most, fan=3)
    want = df.groupBy("g").agg(F.count("*").alias("n"), F.sum("x").alias("total"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert custom.map_groups_in_parts(df.limit(0), "g", partial, merge, "g string, n long, total double").collect() == []


def test_ranks_by_ranges(spark):
    df = spark.createDataFrame([(i, None if i % 11 == 0 else float(i * 7 % 100)) for i in range(500)], "k long, x double").repartition(4)
    want = df.toPandas().set_index("k").x.rank()
    for most in (7, 1000):
        counts, part = order.value_counts(df, "x", most)
        assert counts.groupBy(part).count().agg(F.max("count")).first()[0] <= max(most * 4, 101)
        got = {r.k: r.rank_x for r in windows.average_rank(df, "x", most=most).collect()}
        assert all(got[k] == (None if math.isnan(v) else v) for k, v in want.items())


def test_time_split_by_ranges(spark, monkeypatch):
    rows = [(f"s{i % 4}", datetime.date(2024, 1, 1) + datetime.timedelta(days=i // 40), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "symbol string, date date, k long").repartition(3)
    whole = order.value_counts
    for most in (1, 5, 100_000):
        monkeypatch.setattr(split, "value_counts", lambda d, c, most=most: whole(d, c, most))
        for share in (0.0, 0.13, 0.5, 1.0):
            got = {r.k for r in split.time_split(df, SPEC, share).filter("split = 'train'").collect()}
            cut = sorted(rows, key=lambda r: (r[1], r[0], r[2]))[: int(1000 * (1 - share))]
            assert got == {r[2] for r in cut}, (most, share)


def test_correlation_matrix_keeps_its_diagonal(panel):
    assert np.diag(stats.correlation_matrix(panel, ["x", "slice"])).tolist() == [1.0, 1.0]
