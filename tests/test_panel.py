"""Panel operators on small frames with nulls, ties, short groups and repeated dates."""

import datetime
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkiln.functions import rowmath
from panelkiln.operators import clean, ensemble, history, run_metrics, selection, split, stats, windows
from panelkiln.spec import PanelSpec

SPEC = PanelSpec("symbol", "date", ("k",))


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(0)
    rows = []
    for s, n in (("A", 1), ("B", 5), ("C", 300), ("D", 40)):
        for i in range(n):
            rows.append((s, datetime.date(2024, 1, 1) + datetime.timedelta(days=i // 2), len(rows), None if i % 7 == 3 else float(rng.normal(100, 5)), 3.0))
    return pd.DataFrame(rows, columns=["symbol", "date", "k", "x", "c"])


@pytest.fixture(scope="module")
def panel(spark, frame):
    data = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in frame.itertuples(index=False)]
    return spark.createDataFrame(data, "symbol string, date date, k long, x double, c double")


def values(df, column):
    return np.array([np.nan if r[0] is None else r[0] for r in df.orderBy("k").select(column).collect()], float)


def test_rolling(panel, frame):
    got = windows.rolling(panel, SPEC, ["x"], [3, 20])
    for n in (3, 20):
        for fn in ("mean", "std", "max", "min"):
            want = frame.groupby("symbol").x.rolling(n, min_periods=1).agg(fn).reset_index(drop=True)
            np.testing.assert_allclose(values(got, f"x_roll_{n}_{fn}"), want, rtol=1e-9)


@pytest.mark.parametrize("parts", [1, 16])
def test_ewm(panel, frame, parts):
    df = panel.repartition(parts)
    for span in (2, 5, 40):
        np.testing.assert_allclose(values(windows.ewm_mean(df, SPEC, "x", span), f"x_ewm_{span}"), frame.groupby("symbol").x.ewm(span=span).mean().reset_index(drop=True), rtol=1e-9)
        np.testing.assert_allclose(values(windows.ewm_std(df, SPEC, "x", span), f"x_ewm_std_{span}"), frame.groupby("symbol").x.ewm(span=span).std().reset_index(drop=True), rtol=1e-6)
    full = frame.assign(x=frame.x.fillna(0.0))
    np.testing.assert_allclose(values(windows.ema(df.fillna(0.0), SPEC, "x", 12), "x_ema_12"), full.groupby("symbol").x.transform(lambda v: v.ewm(span=12, adjust=False).mean()), rtol=1e-9)


def test_one_exchange_for_all_windows(panel):
    plan = windows.generate(panel, SPEC, ["x"], [3, 7], [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_average_rank(panel, frame):
    np.testing.assert_allclose(values(windows.average_rank(panel.withColumn("x", F.round("x")), "x"), "rank_x"), frame.x.round().rank())


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (3.0, None)], "a double, b double")
    got = clean.impute_mean(df).collect()
    assert [r.a for r in got] == [1.0, 2.0, 2.0, 3.0] and {r.b for r in got} == {0.0}
    assert {r.column: r.n_missing for r in clean.missing_report(df).collect()} == {"a": 2, "b": 4}
    with pytest.raises(ValueError):
        clean.conform_keys(df.withColumn("symbol", F.lit("A")))


def test_constant_columns(panel):
    assert stats.target_correlations(panel, ["c"], "x").first()["corr"] is None
    assert selection.zero_variance(panel, ["x", "c"]) == ["x"]


def test_row_statistics(spark):
    rows = [(1.0, 2.0, 4.0, 9.0, 0), (5.0, 5.0, 5.0, 5.0, 1), (1.0, None, 3.0, None, 2), (None, None, None, None, 3)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, k int")
    got = rowmath.add(df, rowmath.row_statistics(["a", "b", "c", "d"], "r")).orderBy("k").toPandas()
    want = pd.DataFrame([r[:4] for r in rows], dtype=float)
    np.testing.assert_allclose(got.r_mean.astype(float), want.mean(axis=1))
    np.testing.assert_allclose(got.r_std.astype(float), want.std(axis=1))
    np.testing.assert_allclose(got.r_q25.astype(float), want.quantile(0.25, axis=1))
    assert abs(got.r_skew[0] - want.skew(axis=1)[0]) < 1e-12 and abs(got.r_kurt[0] - want.kurt(axis=1)[0]) < 1e-12
    assert got.r_skew[1:].isna().all() and got.r_kurt[1:].isna().all()


def test_feature_book(spark, tmp_path):
    book = history.FeatureBook(spark, str(tmp_path))
    one = spark.createDataFrame([("A", "2025-01-01", 1.0, 2, 3, 1.0, 2.0)], "symbol string, date string, price double, volume long, market_cap long, feature1 double, feature2 double")
    two = one.withColumn("new_feature1", F.lit(1.0)).withColumn("new_feature2", F.lit(2.0))
    a = book.register_file("day1", "alternative", "20250101")
    assert a == book.register_file("day1", "alternative", "20250101") and book.files().count() == 1
    assert book.only_new(one, "alternative").columns == one.columns
    for _ in range(2):
        book.register_features(a, one, "alternative", "20250101")
    assert book.features().count() == 7
    assert book.only_new(two, "alternative").columns == ["symbol", "date", "new_feature1", "new_feature2"]
    b = book.register_file("day2", "alternative", "20250102")
    book.register_features(b, two, "alternative", "20250102")
    assert book.counts().first().n_features == 9
    assert {r.feature: (r.first_seen, r.last_seen) for r in book.seen().collect()}["price"] == ("20250101", "20250102")


def test_history(spark):
    rows = [("e", "f", "1", 1), ("e", "f", "1", 2), ("e", "f", None, 3), ("e", "f", "2", 4)]
    h = history.validity_history(spark.createDataFrame(rows, "entity string, feature string, value string, valid_from int"))
    assert [tuple(r)[2:] for r in h.orderBy("valid_from").collect()] == [("1", 1, 3), (None, 3, 4), ("2", 4, None)]
    assert [tuple(r) for r in history.delta(h, 1, 4).collect()] == [("e", "f", "1", "2")] and history.as_of(h, 2, ["f"]).first().f == "1"


def test_time_split_and_samples(panel):
    got = split.time_split(panel, SPEC, 0.25)
    assert got.filter("split = 'train'").count() == int(panel.count() * 0.75)
    assert got.filter("split = 'train'").agg(F.max("date")).first()[0] <= got.filter("split = 'test'").agg(F.min("date")).first()[0]
    ids = lambda df: {r.k for r in df.collect()}
    assert ids(clean.hash_sample(panel, ["k"], 0.3)) == ids(clean.hash_sample(panel.repartition(7), ["k"], 0.3))


def test_ensemble_checks(spark):
    p = spark.createDataFrame([("a", "s", 0.2), ("b", "s", 0.6), ("a", "t", 0.4)], "model string, symbol string, prediction double")
    with pytest.raises(ValueError):
        ensemble.weighted_ensemble(p)
    r = ensemble.output_check(spark.createDataFrame([("s", 0.5), ("s", 1.5), ("t", None)], "symbol string, prediction double")).first()
    assert tuple(r) == (3, 1, 1, 1, False)


def test_run_store(spark, tmp_path):
    store = run_metrics.RunStore(spark, str(tmp_path))
    t = datetime.datetime(2025, 1, 1)
    store.append("runs", [("r", 1, t, "started", "{}")], 0)
    store.append("runs", [("r", 1, t, "done", '{"metrics": {"rmse": 0.5}}')], 1)
    store.append_model(("m", "r", "gbt", t, '{"rmse": 0.4}', "{}"), {"x": 0.7, "y": 0.3}, 0)
    assert store.read("runs").first().status == "done"
    assert run_metrics.metric_history(store.read("runs"), "rmse").first().value == 0.5
    assert run_metrics.models_with_importance(store.read("models"), store.read("feature_importance")).first().importance == {"x": 0.7, "y": 0.3}


def test_model_queries_run_a_preset_unchanged(spark, monkeypatch):
    from panelkiln.operators import modeling
    from panelkiln.plans.registry import QUERIES

    from .conftest import DATA

    assert [(p["maxDepth"], p["maxIter"]) for p in modeling.PRESETS.values()] == [(12, 2000), (10, 2000), (8, 2000)]
    assert [p["maxDepth"] for p in modeling.FOREST.values()] == [12, 10, 8]

    class Asked(Exception):
        pass

    def estimator(kind, preset, label, validation, **params):
        raise Asked(params)

    monkeypatch.setattr(modeling, "estimator", estimator)
    for name in ("fit_boosted_trees", "fit_forest", "fit_classifier", "registry_and_score", "compare_models"):
        try:
            QUERIES[name](spark, DATA)
        except Asked as e:
            (params,) = e.args
            assert not params
        else:
            raise AssertionError(name)
