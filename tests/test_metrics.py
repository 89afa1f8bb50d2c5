import math

import pytest
from pyspark.sql import functions as F

from roomtide.functions.numeric import sig_round, sig_str
from roomtide.operators import metrics

# Published metric rows that the counts must reproduce: Accuracy, RMSE, F1, F1 neg, tnr, fpr, fnr, tpr, tn, fp, fn, tp.
PUBLISHED = [
    (0.9757, 0.156, 0.9857, 0.919, 0.899, 0.101, 0.0104, 0.99, 471, 53, 30, 2857),
    (0.9435, 0.2378, 0.957, 0.9174, 0.924, 0.0759, 0.0466, 0.953, 633, 52, 62, 1269),
    (0.9506, 0.2222, 0.9699, 0.8625, 0.825, 0.175, 0.0205, 0.98, 624, 132, 67, 3209),
    (0.9678, 0.1796, 0.9813, 0.8812, 0.855, 0.145, 0.0138, 0.986, 241, 41, 24, 1710),
    (0.9688, 0.1768, 0.9825, 0.8556, 0.838, 0.162, 0.015, 0.985, 160, 31, 23, 1514),
    (0.9455, 0.2334, 0.9092, 0.9611, 0.94, 0.0603, 0.0397, 0.96, 3100, 199, 52, 1257),
    (0.9648, 0.1877, 0.9783, 0.9055, 0.881, 0.119, 0.0155, 0.985, 1160, 156, 86, 5465),
    (0.9676, 0.18, 0.9817, 0.86, 0.789, 0.211, 0.00662, 0.993, 172, 46, 10, 1500),
]
COLUMNS = (*metrics.DIGITS, *metrics.COUNTS)


def test_counts_reproduce_published_metrics(spark):
    counts = spark.createDataFrame(
        [(i, *row[8:]) for i, row in enumerate(PUBLISHED)],
        "row INT, tn LONG, fp LONG, fn LONG, tp LONG",
    )
    report = metrics.to_report_digits(metrics.model_metrics(counts)).orderBy("row")
    assert [tuple(r[c] for c in COLUMNS) for r in report.collect()] == PUBLISHED


def test_absent_class_gives_zero_rates(spark):
    counts = spark.createDataFrame(
        [(0, 0, 0, 5), (0, 0, 0, 0)], "tn LONG, fp LONG, fn LONG, tp LONG"
    )
    rows = metrics.model_metrics(counts).orderBy("tp").collect()
    assert rows[1].tnr == rows[1].fpr == rows[1]["F1 neg"] == 0.0 and rows[1].Accuracy == 1.0
    assert rows[0].Accuracy == 0.0


def test_identities(spark):
    predictions = spark.range(500).selectExpr(
        "cast(rand(1) > 0.4 AS INT) AS occupied", "cast(rand(2) > 0.5 AS INT) AS pred",
        "id % 3 AS k",
    )
    for r in metrics.model_metrics(metrics.confusion(predictions, ["k"])).collect():
        assert r.tpr + r.fnr == pytest.approx(1) and r.tnr + r.fpr == pytest.approx(1)
        assert r.RMSE ** 2 == pytest.approx(1 - r.Accuracy)


def test_several_predictors_in_one_pass(spark):
    df = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (0, 0, 1)], "occupied INT, a INT, b INT"
    )
    got = metrics.confusion_of_predictors(df, [], {"first": "a", "second": "b"})
    assert {tuple(r) for r in got.collect()} == {("first", 1, 0, 1, 1), ("second", 0, 1, 2, 0)}


def test_confusion_table(spark):
    df = spark.createDataFrame([("H1", 1, 1), ("H1", 0, 1), ("H1", 0, 0)],
                               "home STRING, occupied INT, pred INT")
    got = {tuple(r) for r in metrics.confusion_table(df, ["home"]).collect()}
    assert got == {("H1", "Vacant", 1, 1), ("H1", "Occupied", 0, 1)}


@pytest.mark.parametrize("digits", [2, 3, 4])
def test_significant_digits_like_general_format(spark, digits):
    values = [0.0, 1.0, 0.5, 0.014449, 0.00662, 0.99996, 0.096, 0.000963, 0.0000123, 0.3, 0.8499]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select(
        "v", sig_round(F.col("v"), digits).alias("r"), sig_str(F.col("v"), digits).alias("s")
    )
    for row in df.collect():
        assert row.r == float(f"{row.v:.{digits}}")
        assert row.s == f"{row.v:.{digits}}"


def test_rmse_of_fixed_counts(spark):
    counts = spark.createDataFrame([(1, 2, 3, 4)], "tn LONG, fp LONG, fn LONG, tp LONG")
    assert metrics.model_metrics(counts).first().RMSE == pytest.approx(math.sqrt(0.5))
