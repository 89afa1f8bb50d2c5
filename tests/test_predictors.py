import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import START, feature_rows
from roomtide.operators import predictors
from roomtide.schemas import FEATURES, LAGS


def sigmoid(z):
    return 1 / (1 + np.exp(-z))


def brute_force_rollout(x, weights, span=12):
    """The recurrence written out row by row."""
    exog, lags = x[:, :9], x[:, 9:]
    p = np.zeros(len(x))
    for r in range(len(x)):
        z = weights[-1] + exog[r] @ weights[:9]
        for j in range(8):
            lo = r - span * j - span
            z += weights[9 + j] * (p[lo:lo + span].mean() if lo >= 0 else lags[r, j])
        p[r] = sigmoid(z)
    return p


def frame(spark, series):
    rows, expected = [], {}
    for name, (x, weights) in series.items():
        for i, row in enumerate(x):
            rows.append((name, i, START + dt.timedelta(minutes=5 * i), 1,
                         *map(float, row), [float(w) for w in weights]))
        expected[name] = brute_force_rollout(x, weights)
    schema = ("series_id STRING, series_pos LONG, ts TIMESTAMP_NTZ, occupied INT, "
              + ", ".join(f"{f} DOUBLE" for f in FEATURES) + ", coef ARRAY<DOUBLE>")
    return spark.createDataFrame(rows, schema).repartition(5), expected


def test_rollout_equals_the_recurrence(spark):
    rng = np.random.default_rng(7)
    series = {
        f"s{i}": (feature_rows(n, i)[0], rng.normal(0, 2, 18))
        for i, n in enumerate([1, 11, 12, 13, 50, 95, 96, 97, 300, 421])
    }
    df, expected = frame(spark, series)
    ready = predictors.rollout_input(df).select(
        "series_id", "series_pos", "ts", "occupied", "base", "lag_weights"
    )
    got = predictors.rollout(ready).orderBy("series_id", "series_pos").toPandas()
    assert len(got) == sum(map(len, expected.values()))
    for name, probs in expected.items():
        rows = got[got.series_id == name]
        np.testing.assert_allclose(rows.prob_ar.to_numpy(), probs, atol=1e-12)
        np.testing.assert_array_equal(rows.pred_ar.to_numpy(), (probs > 0.5).astype(int))


def test_true_lag_score(spark):
    x, _ = feature_rows(20, 4)
    weights = np.linspace(-2, 2, 18)
    df, _ = frame(spark, {"a": (x, weights)})
    got = predictors.score_true_lags(df).orderBy("series_pos").toPandas()
    expected = sigmoid(x @ weights[:17] + weights[17])
    np.testing.assert_allclose(got.prob_gt, expected, atol=1e-12)
    np.testing.assert_array_equal(got.pred_gt, (expected > 0.5).astype(int))


def test_or_baseline_is_strict(spark):
    df = spark.createDataFrame(
        [(0.5, 0.1, 0.0, 0.0, 0.0, 0.9), (0.2, 0.51, 0.0, 0.0, 0.0, 0.0), (None,) * 6],
        "audio DOUBLE, img DOUBLE, temp DOUBLE, rh DOUBLE, light DOUBLE, co2eq DOUBLE",
    )
    rows = predictors.or_baseline(df).collect()
    assert [(r.pred_ai, r.pred_aie) for r in rows] == [(0, 1), (1, 1), (0, 0)]


def test_time_of_day_lookup(spark):
    train = spark.createDataFrame(
        [("H1", 0, 0, 1), ("H1", 0, 0, 0), ("H1", 0, 5, 0), ("H2", 1, 0, 1)],
        "home STRING, weekend INT, tod_min INT, occupied INT",
    )
    test = spark.createDataFrame(
        [("H1", 0, 0), ("H1", 0, 5), ("H1", 1, 0)], "home STRING, weekend INT, tod_min INT"
    )
    found = predictors.time_of_day_predict(test, predictors.time_of_day_model(train))
    got = {(r.weekend, r.tod_min): (r.prob_np, r.pred_np) for r in found.collect()}
    assert got == {(0, 0): (0.5, 1), (0, 5): (0.0, 0), (1, 0): (None, 0)}


@pytest.mark.parametrize("lag", LAGS[:2])
def test_base_uses_the_true_lag_only_at_the_start(spark, lag):
    x, _ = feature_rows(40, 9)
    weights = np.zeros(18)
    weights[FEATURES.index(lag)] = 1.0
    df, _ = frame(spark, {"a": (x, weights)})
    rows = predictors.rollout_input(df).orderBy("series_pos").select(F.col("base")).collect()
    span = 12 * (LAGS.index(lag) + 1)
    expected = np.where(np.arange(40) < span, x[:, FEATURES.index(lag)], 0.0)
    np.testing.assert_array_equal([r.base for r in rows], expected)


def test_series_are_dealt_evenly_and_told_apart(spark):
    lengths = spark.createDataFrame([(f"s{i}", 1 + (i * 37) % 100) for i in range(103)], "series_id STRING, n LONG")
    for together in (100_000, 10):
        placed = predictors.place_series(lengths, 8, together).join(lengths, "series_id").collect()
        assert len(placed) == 103 and len({(r.task, r.slot) for r in placed}) == 103
    placed = predictors.place_series(lengths, 8).join(lengths, "series_id").collect()
    rows = [sum(r.n for r in placed if r.task == t) for t in range(8)]
    assert max(rows) - min(rows) <= 100 and {r.task for r in placed} == set(range(8))


@pytest.mark.parametrize("span", [1, 3])
def test_rollout_with_other_windows(spark, span):
    rng = np.random.default_rng(3)
    series = {f"s{i}": (feature_rows(n, i)[0], rng.normal(0, 2, 18)) for i, n in enumerate([1, 2, 40])}
    df, _ = frame(spark, series)
    ready = predictors.rollout_input(df, rows_per_lag=span).select("series_id", "series_pos", "base", "lag_weights")
    got = predictors.rollout(ready, rows_per_lag=span).orderBy("series_id", "series_pos").toPandas()
    for name, (x, weights) in series.items():
        np.testing.assert_allclose(got[got.series_id == name].prob_ar, brute_force_rollout(x, weights, span), atol=1e-12)


def test_ids_hold_names_with_bars_and_backslashes(spark):
    from roomtide.plans import experiments

    names = [("H1", "H2"), ("a|b", "c"), ("a", "b|c"), ("\\", "|"), ("x\\|", "\\y"), ("", "z")]
    df = spark.createDataFrame(names, "a STRING, b STRING").withColumn("id", experiments.joined_id("a", "b"))
    rows = df.select("a", "b", "id", *[p.alias(n) for p, n in zip(experiments.id_parts("id"), ("first", "second"))]).collect()
    assert all((r.a, r.b) == (r.first, r.second) for r in rows)
    assert len({r.id for r in rows}) == len(names) and rows[0].id == "H1|H2"
