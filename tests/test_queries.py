"""Registered queries against their SQL on the driver's smallest tables."""

import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cells(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def clean(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "-"
        return repr(float(v)) if isinstance(v, (int, float)) else str(v)

    return [columns[i] for i in order], sorted(tuple(clean(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    result = driver.queries()[name](spark, FOLDER)
    expected = duck.sql(driver.oracle_sql()[name])
    assert cells(result.columns, result.collect()) == cells(expected.columns, expected.fetchall())


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 6


def test_lookup_matrix_equals_long_predictions(spark):
    """The counted-cells shortcut agrees with the full experiment."""
    metrics = driver.queries()["cross_home"](spark, FOLDER)
    full = {(r.train, r.test): (r.tn, r.fp, r.fn, r.tp)
            for r in metrics.where("function = 'Nonparametric'").collect()}
    counted = driver.queries()["cross_home_nonparametric"](spark, FOLDER).collect()
    assert full == {(r.train, r.test): (r.tn, r.fp, r.fn, r.tp) for r in counted}
    assert len(full) == 36


@pytest.mark.parametrize("name", ["split_sweep", "ffa_experiment_effects", "run_params"])
def test_experiments_run(spark, name):
    result = driver.queries()[name](spark, FOLDER)
    assert result.count() == {"split_sweep": 350, "ffa_experiment_effects": 39, "run_params": 6}[name]


def test_sweep_keeps_test_rows_without_known_lags(spark):
    """The lookup scores every test row, also the first ones of a recording."""
    keys = ("home", "split", "direction")
    sweep = driver.queries()["split_sweep"](spark, FOLDER).where("function = 'Nonparametric'")
    counted = driver.queries()["split_direction_nonparametric"](spark, FOLDER)
    cells_of = {name: {tuple(str(r[k]) for k in keys): (r.tn, r.fp, r.fn, r.tp) for r in df.collect()}
                for name, df in (("sweep", sweep), ("counted", counted))}
    assert cells_of["sweep"] == {k: cells_of["counted"][k] for k in cells_of["sweep"]}
    assert len(cells_of["sweep"]) == 70


@pytest.mark.parametrize(("name", "design"), [
    ("ffa_experiment", "design_full"), ("ffa_experiment_half", "design_half"), ("ffa_features_full", "design_full")])
def test_factorial_queries_run_their_whole_design(spark, name, design):
    runs = [{(r.home, r.run) for r in driver.queries()[q](spark, FOLDER).select("home", "run").distinct().collect() if r.run}
            for q in (name, design)]
    assert runs[0] == runs[1] and len({home for home, _ in runs[0]}) > 1


def test_metrics_from_counts_equal_those_of_the_predictions(spark):
    """Cross-home metrics, counted apart by predictor, against the table of all predictions."""
    from roomtide.plans import experiments
    from roomtide.plans.registry import HOMES, HOUR, sensor_readings

    found, _, predictions = experiments.cross_home(sensor_readings(spark, FOLDER), HOMES, HOUR)
    columns = ["function", "tn", "fp", "fn", "tp"]
    direct = experiments.experiment_metrics(predictions).select("series_id", *columns).collect()
    counted = found.select(F.concat_ws("|", "train", "test").alias("series_id"), *columns).collect()
    assert sorted(map(tuple, direct)) == sorted(map(tuple, counted))
    assert len(direct) == 36 * 5


def test_sweep_scores_the_regressions_on_rows_with_lags_only(spark):
    sweep = driver.queries()["split_sweep"](spark, FOLDER)
    rows = {}
    for r in sweep.collect():
        rows.setdefault((r.home, r.split, r.direction), {})[r.function] = r.tn + r.fp + r.fn + r.tp
    for (_, _, direction), n in rows.items():
        assert n["ground truth AR"] == n["AR predictions (aie)"]
        assert n["OR (ai)"] == n["OR (aie)"] == n["Nonparametric"]
        missing = n["OR (ai)"] - n["ground truth AR"]
        assert missing == (96 if direction == "reverse" else 0) or n["ground truth AR"] == 0


ORDERED = {
    "cross_home_nonparametric": [("function", True), ("self/cross", False)],
    "split_direction_nonparametric": [("home", True), ("function", False), ("split", True), ("direction", True)],
    "split_sweep": [("home", True), ("function", False), ("split", True), ("direction", True)],
    "cross_home": [("function", True), ("self/cross", False)],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_reports_come_in_their_order(spark, name):
    rows = driver.queries()[name](spark, FOLDER).collect()
    wanted = rows
    for column, ascending in reversed(ORDERED[name]):
        wanted = sorted(wanted, key=lambda r: r[column], reverse=not ascending)
    keys = [c for c, _ in ORDERED[name]]
    assert [[r[k] for k in keys] for r in rows] == [[r[k] for k in keys] for r in wanted]
    assert len({tuple(r[k] for k in keys) for r in rows}) > 1
