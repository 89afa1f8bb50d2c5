import datetime as dt

import numpy as np
import pytest

from helpers import START, feature_rows
from roomtide.operators import models
from roomtide.schemas import FEATURES


def training_frame(spark, sets, folds=None):
    rows = []
    for name, (x, y) in sets.items():
        for i in range(len(y)):
            fold = -1 if folds is None else int(folds[i])
            rows.append((name, fold, *map(float, x[i]), float(y[i])))
    schema = ("dataset STRING, fold INT, " + ", ".join(f"{f} DOUBLE" for f in FEATURES)
              + ", occupied DOUBLE")
    return spark.createDataFrame(rows, schema).repartition(3).cache()


def optimality_gap(x, y, coef, c):
    design = np.column_stack([x, np.ones(len(x))])
    gradient = design.T @ (1 / (1 + np.exp(-design @ coef)) - y)
    w, inner, lam = coef[:-1], gradient[:-1], 1 / c
    breach = np.where(w == 0, np.maximum(np.abs(inner) - lam, 0), np.abs(inner + lam * np.sign(w)))
    return max(breach.max(), abs(gradient[-1])) / lam


@pytest.fixture(scope="module")
def sets():
    return {"a": feature_rows(400, 1), "b": feature_rows(300, 2), "c": feature_rows(350, 3, 0.05)}


def test_every_fit_is_optimal(spark, sets):
    rows = training_frame(spark, sets)
    fits = [models.Fit(name, c) for name in sets for c in (0.01, 0.1, 3.0, 1000.0)]
    got = models.fit_l1(rows, fits).collect()
    assert len(got) == len(fits)
    for m in got:
        assert optimality_gap(*sets[m.dataset], np.array(m.coef), m.c) < 1e-5


def test_mllib_reaches_the_same_optimum(spark, sets):
    rows = training_frame(spark, {"a": sets["a"]})
    ours = models.fit_l1(rows, [models.Fit("a", 0.5)]).first().coef
    theirs = models.fit_mllib(rows, 0.5)
    np.testing.assert_allclose(ours[:-1], theirs.coefficients.toArray(), atol=2e-3)
    assert ours[-1] == pytest.approx(theirs.intercept, abs=2e-3)


def test_constant_column_equals_dropping_it(spark, sets):
    x, y = sets["a"]
    zeroed = x.copy()
    zeroed[:, 1:6] = 0.0
    coef = models.fit_l1(training_frame(spark, {"a": (zeroed, y)}), [models.Fit("a", 1.0)]).first().coef
    assert coef[1:6] == [0.0] * 5


def test_held_out_fold_is_not_used(spark, sets):
    x, y = sets["a"]
    folds = np.arange(len(y)) % 5
    rows = training_frame(spark, {"a": (x, y)}, folds)
    for m in models.fit_l1(rows, [models.Fit("a", 0.3, k) for k in range(5)]).collect():
        keep = folds != m.holdout
        assert optimality_gap(x[keep], y[keep], np.array(m.coef), 0.3) < 1e-5


def stratified_folds(y, k=5):
    """Consecutive blocks per class whose sizes follow the sorted labels dealt round-robin."""
    classes = list(dict.fromkeys(y.tolist()))
    codes = np.array([classes.index(v) for v in y])
    dealt = np.sort(codes)
    sizes = [[int((dealt[i::k] == c).sum()) for i in range(k)] for c in range(len(classes))]
    out = np.empty(len(y), int)
    for c in range(len(classes)):
        out[codes == c] = np.repeat(np.arange(k), sizes[c])
    return out


@pytest.mark.parametrize("n, first", [(233, 1), (301, 0), (47, 1)])
def test_folds(spark, n, first):
    rng = np.random.default_rng(n)
    y = rng.integers(0, 2, n)
    y[0] = first
    times = [START + dt.timedelta(minutes=37 * i) for i in range(n)]
    df = spark.createDataFrame(
        [("d", t.date(), t, int(v)) for t, v in zip(times, y)],
        "dataset STRING, day DATE, ts TIMESTAMP_NTZ, occupied INT",
    )
    got = models.assign_folds(df, ["dataset"]).orderBy("ts").toPandas()
    np.testing.assert_array_equal(got.fold.to_numpy(), stratified_folds(y))


def test_cross_validation_scores_and_choice(spark, sets):
    x, y = sets["a"]
    folds = stratified_folds(y)
    rows = training_frame(spark, {"a": (x, y)}, folds)
    strengths = [0.001, 0.1, 10.0]
    scores = {r.c: r.accuracy for r in models.cross_validate(rows, ["a"], strengths).collect()}
    for c in strengths:
        right = []
        for m in models.fit_l1(rows, [models.Fit("a", c, k) for k in range(5)]).collect():
            test = folds == m.holdout
            guess = np.column_stack([x[test], np.ones(test.sum())]) @ np.array(m.coef) > 0
            right.append(np.mean(guess == (y[test] > 0.5)))
        assert scores[c] == pytest.approx(np.mean(right))
    chosen = models.best_strengths(
        spark.createDataFrame([("a", c, s) for c, s in scores.items()],
                              "dataset STRING, c DOUBLE, accuracy DOUBLE")
    ).first().c
    assert chosen == min(scores, key=lambda c: (-scores[c], c))


def test_ties_go_to_the_smallest_strength(spark):
    scores = spark.createDataFrame([("a", 1.0, 0.9), ("a", 0.1, 0.9), ("a", 0.01, 0.8)],
                                   "dataset STRING, c DOUBLE, accuracy DOUBLE")
    assert models.best_strengths(scores).first().c == 0.1


def test_candidates_hold_published_choices():
    grid = np.array(models.candidate_strengths())
    # Published strengths.
    for c in (4.893900918477489, 0.7278953843983146, 1.3738237958832638, 2.592943797404667):
        assert np.min(np.abs(grid - c)) < 1e-12


def test_coefficient_rows(spark):
    fitted = spark.createDataFrame(
        [("H1", 0.1, -1, [float(i) for i in range(18)], 1, 0.0)], models.MODEL_SCHEMA
    )
    rows = {r.term: r.value for r in models.coefficient_rows(fitted).collect()}
    assert rows["audio"] == 0.0 and rows["Intercept"] == 17.0 and rows["C"] == 0.1
    assert len(rows) == 20


def test_sets_spread_over_tasks_get_the_same_fits(spark, sets, monkeypatch):
    """Passes over stored blocks end where the task-local solver does."""
    folds = {name: stratified_folds(y) for name, (_, y) in sets.items()}
    rows = []
    for name, (x, y) in sets.items():
        rows += [(name, int(f), *map(float, r), float(v)) for f, r, v in zip(folds[name], x, y)]
    schema = "dataset STRING, fold INT, " + ", ".join(f"{f} DOUBLE" for f in FEATURES) + ", occupied DOUBLE"
    frame = spark.createDataFrame(rows, schema).repartition(4).cache()
    fits = [models.Fit(n, c, k) for n in sets for c in (0.02, 0.5, 20.0) for k in (models.NO_HOLDOUT, 0, 3)]
    solved = {}
    for local in (1 << 18, 320):  # then "a" and "c" are spread out, "b" is not
        monkeypatch.setattr(models, "LOCAL_ROWS", local)
        monkeypatch.setattr(models, "BLOCK_ROWS", 37)
        solved[local] = {(r.dataset, r.c, r.holdout): r for r in models._solve(frame, fits, 1e-9, 500).collect()}
    assert set(solved[320]) == set(solved[1 << 18]) == {(f.dataset, f.c, f.holdout) for f in fits}
    for key, one in solved[1 << 18].items():
        other = solved[320][key]
        np.testing.assert_allclose(one.coef, other.coef, atol=1e-6)
        assert (one.right_rows, one.held_rows) == (other.right_rows, other.held_rows)
        assert one.held_rows == (0 if key[2] == models.NO_HOLDOUT else int((folds[key[0]] == key[2]).sum()))


def test_ten_thousand_sets_in_one_call(spark):
    from pyspark.sql import functions as F

    n, per = 10_000, 12
    base = spark.range(n * per).select(
        (F.col("id") % n).cast("string").alias("dataset"), F.lit(models.NO_HOLDOUT).alias("fold"),
        *[(F.abs(F.hash("id", F.lit(f))) % 1000 / 1000).alias(f) for f in FEATURES],
        (F.abs(F.hash(F.lit("y"), "id")) % 2).cast("double").alias("occupied"))
    asked = spark.range(n).select(F.col("id").cast("string").alias("dataset"), F.lit(2.0).alias("c"),
                                  F.lit(models.NO_HOLDOUT).alias("holdout"))
    base = base.cache()
    fitted = models.fit_l1(base, asked)
    assert fitted.count() == n
    some = {r.dataset: np.array(r.coef) for r in fitted.where("dataset IN ('7', '4711', '9999')").collect()}
    for name, coef in some.items():
        own = base.where(F.col("dataset") == name).toPandas()
        assert optimality_gap(own[list(FEATURES)].to_numpy(), own.occupied.to_numpy(), coef, 2.0) < 1e-5


@pytest.mark.parametrize("local", [1 << 18, 10])
def test_a_fit_out_of_passes_raises(spark, sets, monkeypatch, local):
    monkeypatch.setattr(models, "LOCAL_ROWS", local)
    rows = training_frame(spark, {"a": sets["a"]})
    with pytest.raises(models.NotConverged, match="2 passes"):
        models.fit_l1(rows, [models.Fit("a", 1.0)], max_passes=2)
    assert models.fit_l1(rows, [models.Fit("a", 1e-9)], max_passes=60).first().coef[:-1] == [0.0] * 17


def test_configured_iterations_bound_the_training(spark):
    import datetime as dt

    from pyspark.sql import functions as F
    from roomtide.plans import experiments
    from roomtide.sources.config import TrainConfig

    x, y = feature_rows(200, 5)
    rows = [("H1", START + dt.timedelta(minutes=5 * i), (START + dt.timedelta(minutes=5 * i)).date(), 0, 5 * i % 1440,
             i, int(y[i]), *map(float, x[i])) for i in range(200)]
    schema = ("home STRING, ts TIMESTAMP_NTZ, day DATE, other INT, tod_min INT, pos LONG, occupied INT, "
              + ", ".join(f"{f} DOUBLE" for f in FEATURES))
    frame = spark.createDataFrame(rows, schema)
    days = frame.select("home", "day").distinct().withColumn("dataset", F.col("home"))
    with pytest.raises(models.NotConverged):
        experiments.train(frame, days, TrainConfig(max_iter=1))
    assert experiments.train(frame, days, TrainConfig()).models.count() == 1


def test_a_path_of_strengths_takes_few_passes(spark, sets):
    rows = training_frame(spark, {"a": sets["a"]})
    strengths = models.candidate_strengths()
    path = models.fit_l1(rows, [models.Fit("a", c) for c in strengths]).collect()
    alone = [models.fit_l1(rows, [models.Fit("a", c)]).first() for c in strengths]
    assert 2.7 * sum(m.passes for m in path) <= sum(m.passes for m in alone)
    for one, other in zip(sorted(path, key=lambda m: m.c), alone):
        np.testing.assert_allclose(one.coef, other.coef, atol=1e-4 * max(1.0, np.abs(other.coef).max()))
