import datetime as dt
import json

import numpy as np
import pytest

from helpers import START, readings
from roomtide.operators import labels, reports
from roomtide.operators.splits import (
    assign_split,
    awake_only,
    common_days,
    keep_days,
    with_directions,
)
from roomtide.plans.registry import HOMES
from roomtide.schemas import METRICS
from roomtide.sources import config, sinks
from roomtide.sources import readings as sources


def test_hub_files(spark, tmp_path):
    header = "timestamp,audio,img,temp,rh,light,co2eq,occupied\n"
    (tmp_path / "H1RS1.csv").write_text(header + "2024-01-05 00:00:00,0.5,NaN,,0,0,0,1\n")
    (tmp_path / "H6BS3_prob.csv").write_text(header + "2024-01-05 00:00:10,0.1,0.2,0,0,0,0,0\n")
    rows = {r.home: r for r in sources.read_hub_csv(spark, f"{tmp_path}/*.csv").collect()}
    assert rows["H1"].hub == "RS1" and rows["H6"].hub == "BS3"
    assert rows["H1"].ts == START and rows["H1"].audio == 0.5
    assert rows["H1"].img is None and rows["H1"].temp is None


def test_relabelling(spark, tmp_path):
    (tmp_path / "truth.csv").write_text(
        "timestamp,anna,ben,occupied\n2024-01-05 00:00:00,0,1,0\n2024-01-05 00:02:00,0,0,1\n"
    )
    truth = sources.read_truth_csv(spark, f"{tmp_path}/truth.csv", "H1", ["anna", "ben"])
    source = readings(spark, [
        ("H1", "RS1", 0, 0, {"audio": 0.3}), ("H1", "RS1", 1, 1, {}), ("H1", "RS1", 2, 1, {}),
        ("H1", "RS2", 0, 1, {}),
    ])
    matched = labels.match_truth(source, truth)
    relabelled = {(r.hub, r.ts.minute): r.occupied for r in labels.relabel(matched).collect()}
    assert relabelled == {("RS1", 0): 1.0, ("RS1", 2): 0.0, ("RS2", 0): 1.0}
    wide = {r.ts.minute: (r.RS1, r.RS2)
            for r in labels.label_difference_wide(matched, ["RS1", "RS2"]).collect()}
    assert wide == {0: (1.0, 0.0), 2: (-1.0, None)}


def test_configuration(spark):
    homes = config.home_config(spark)
    days = config.range_days(homes)
    counts = {r.home: r.n for r in days.groupBy("home").count()
              .withColumnRenamed("count", "n").collect()}
    # Configured days per home and test days at 0.6.
    assert counts == {"H1": 30, "H2": 17, "H3": 35, "H4": 17, "H5": 15, "H6": 38}
    test_days = assign_split(days).where("role = 'test'").groupBy("home").count().collect()
    assert {r.home: r["count"] for r in test_days} == {
        "H1": 12, "H2": 7, "H3": 14, "H4": 7, "H5": 6, "H6": 16}
    hubs = {}
    for r in config.home_hubs(homes).collect():
        hubs.setdefault(r.home, []).append(r.hub)
    assert sorted(hubs["H6"]) == ["BS2", "BS3", "BS4", "BS5"]
    assert sorted(hubs["H2"]) == ["RS1", "RS2", "RS4", "RS5"]
    assert {r.home for r in config.home_hubs(homes, "BS4").collect()} == {"H6"}
    assert {r.zone_threshold for r in config.home_hubs(homes, "BS5").collect()} == {0.6}


def test_date_range_file(spark, tmp_path):
    path = tmp_path / "dates.json"
    path.write_text(json.dumps({"H1": [["2021-02-03", " 2021-03-04"]],
                                "H3": [["2022-01-01", "2022-01-09"], ["2022-02-10", "2022-02-20"]]},
                               indent=1))
    rows = config.read_date_ranges(spark, str(path)).orderBy("home", "start").collect()
    assert [(r.home, str(r.start), str(r.end)) for r in rows] == [
        ("H1", "2021-02-03", "2021-03-04"), ("H3", "2022-01-01", "2022-01-09"),
        ("H3", "2022-02-10", "2022-02-20")]


def test_split_directions(spark):
    days = spark.createDataFrame(
        [("H1", dt.date(2024, 1, d)) for d in range(1, 11)], "home STRING, day DATE")
    got = with_directions(assign_split(days, [0.3])).collect()
    train = {(r.direction, r.day.day) for r in got if r.role == "train"}
    assert train == {("normal", d) for d in (1, 2, 3)} | {("reverse", d) for d in range(4, 11)}
    assert keep_days(days, days.limit(1)).count() == 1
    assert common_days(days, days.where("day > '2024-01-08'")).count() == 2


def test_sleep_hours_are_half_open(spark):
    df = spark.createDataFrame([(f"{h:02d}:00:00",) for h in range(24)], "hr_min_sec STRING")
    kept = {r[0] for r in awake_only(df, "01:00:00", "03:00:00").collect()}
    assert len(kept) == 22 and "01:00:00" not in kept and "03:00:00" in kept


def coefficient_frame(spark):
    rng = np.random.default_rng(2)
    table = rng.normal(size=(3, 6))
    rows = [(h, t, float(table[i, j])) for i, t in enumerate(("lag1_occupied", "audio", "C"))
            for j, h in enumerate(HOMES)]
    rows += [(h, "cv", 0.0) for h in HOMES]
    return spark.createDataFrame(rows, "train_home STRING, term STRING, value DOUBLE"), table


@pytest.mark.parametrize("compat", [False, True])
def test_coefficient_summary(spark, compat):
    df, table = coefficient_frame(spark)
    kept = np.delete(table, 3, axis=1)
    rows = reports.term_order(reports.coefficient_summary(df, ["H4"], compat)).collect()
    assert [r.term for r in rows] == ["C", "audio", "lag1_occupied"]
    for r, values in zip(rows, kept[::-1]):
        mean = values.mean()
        med = np.median([*values, mean]) if compat else np.median(values)
        derived = [mean, med, values.min(), values.max(), med - values.min(),
                   values.max() - med, mean - values.min(), values.max() - mean]
        spread = np.std([*values, *derived] if compat else values, ddof=1)
        assert (r.mean, r.med) == (pytest.approx(mean), pytest.approx(med))
        assert r.stdev == pytest.approx(spread)
        assert r.errors == pytest.approx(mean - 1.96 * spread / np.sqrt(6))
    joined = reports.join_cv_summary(
        reports.coefficient_summary(df), reports.coefficient_summary(df))
    assert all(r["mean"] == r["mean_cv"] for r in joined.collect())


def test_pivot_refuses_duplicate_cells(spark):
    df = spark.createDataFrame(
        [("f", 0.5, "H1", "H1"), ("f", 0.6, "H1", "H1")],
        "function STRING, Accuracy DOUBLE, train STRING, test STRING")
    with pytest.raises(Exception, match="pivot cell"):
        reports.pivot_train_test(df, "f", "Accuracy", ["H1"]).collect()


def test_f1_labels(spark):
    df = spark.createDataFrame([(0.9188, 0.388), (0.014, 0.25), (0.9415, 0.0), (0.9188, 0.09612)],
                               ["F1", "F1 neg"])
    got = [r.F1s for r in reports.with_f1_label(df).collect()]
    assert got == ["0.92 / 0.39", "0.014 / 0.25", "0.94 / 0.0", "0.92 / 0.096"]


def test_results_round_trip(spark, tmp_path):
    row = ("ground truth AR", 0.75, 0.5, 0.8, 0.6667, 0.667, 0.333, 0.2, 0.8, 2, 1, 1, 4)
    df = spark.createDataFrame([row], METRICS)
    sinks.write_csv(df, f"{tmp_path}/m")
    assert tuple(sinks.read_results_csv(spark, f"{tmp_path}/m", METRICS).first()) == row
    sinks.write_parquet(readings(spark, [("H1", "RS1", 0, 1, {})]), f"{tmp_path}/r", ["home"])
    assert sources.read_readings(spark, f"{tmp_path}/r").first().home == "H1"


def test_coefficient_file(spark, tmp_path):
    (tmp_path / "c.csv").write_text(",H1,H2\nC,0.1,0.1\naudio,0.5,3.25\ncv,False,False\n")
    rows = sinks.read_coefficients_csv(spark, f"{tmp_path}/c.csv", ["H1", "H2"]).collect()
    got = {(r.train_home, r.term): r.value for r in rows}
    assert got[("H2", "audio")] == 3.25 and got[("H1", "cv")] is None


def test_run_record(spark, tmp_path):
    hubs = spark.createDataFrame([("H1", "RS2"), ("H1", "RS1")], "home STRING, hub STRING")
    fitted = spark.createDataFrame([("H1", 0.1)], "dataset STRING, c DOUBLE")
    record = sinks.run_parameters(hubs, fitted, config.TrainConfig())
    row = record.first()
    assert row.hubs == ["RS1", "RS2"] and row.params["C"] == "0.1" and row.best_c == 0.1
    sinks.write_run_parameters(record, f"{tmp_path}/p")
    assert spark.read.json(f"{tmp_path}/p").first().fill == "zeros"


def test_hub_csv_columns_are_found_by_name(spark, tmp_path):
    names = ["img", "extra", "timestamp", "audio", "co2eq", "light", "rh", "temp", "occupied"]
    (tmp_path / "H2RS11.csv").write_text(",".join(names) + "\n2,x,2024-01-05 00:00:00,1,6,5,4,3,1\n")
    row = sources.read_hub_csv(spark, str(tmp_path)).first()
    assert (row.home, row.hub, row.audio, row.img, row.temp, row.rh, row.light, row.co2eq, row.occupied) == (
        "H2", "RS11", 1, 2, 3, 4, 5, 6, 1)


def test_persons_of_a_truth_file_are_discovered(spark, tmp_path):
    (tmp_path / "t.csv").write_text("bo,timestamp,occupied,al\n1,2024-01-05 00:00:00,1,0\n")
    out = sources.read_truth_csv(spark, str(tmp_path), "H1")
    assert out.columns == ["home", "ts", "bo", "al", "occupied"] and out.first().bo == 1


def test_hub_files_with_different_headers_are_read_in_one_call(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "H1RS1.csv").write_text("timestamp,audio,img,temp,rh,light,co2eq,occupied\n2024-01-05 00:00:00,1,2,3,4,5,6,1\n")
    (tmp_path / "a b" / "H1RS2.csv").write_text("occupied,img,timestamp,co2eq,light,rh,temp,audio,more\n0,2,2024-01-05 00:05:00,6,5,4,3,1,x\n")
    (tmp_path / "a b" / "H2RS1.csv").write_text("timestamp,audio,img,temp,rh,light,co2eq,occupied\n2024-01-06 00:00:00,7,,3,4,5,6,1\n")
    found = sources.read_hub_csv(spark, f"{tmp_path}/a b")
    rows = {(r.home, r.hub): (r.audio, r.img, r.temp, r.rh, r.light, r.co2eq, r.occupied) for r in found.collect()}
    assert rows == {("H1", "RS1"): (1, 2, 3, 4, 5, 6, 1), ("H1", "RS2"): (1, 2, 3, 4, 5, 6, 0),
                    ("H2", "RS1"): (7, None, 3, 4, 5, 6, 1)}
    assert sources.csv_headers(spark, f"{tmp_path}/a b").select("header").distinct().count() == 2
