"""Confusion counts and the metrics that follow from them.

Several predictors on one row are counted in a single aggregation and turned into rows
afterwards, so rows are never multiplied by the number of predictors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.functions.numeric import ratio_or_zero, sig_round

COUNTS = ("tn", "fp", "fn", "tp")
# Significant digits of each reported metric.
DIGITS = {"Accuracy": 4, "RMSE": 4, "F1": 4, "F1 neg": 4, "tnr": 3, "fpr": 3, "fnr": 3, "tpr": 3}


def _counts(label: str, prediction: str) -> dict[str, Column]:
    return {
        "tn": F.expr(f"count_if({label} = 0 AND {prediction} = 0)"),
        "fp": F.expr(f"count_if({label} = 0 AND {prediction} = 1)"),
        "fn": F.expr(f"count_if({label} = 1 AND {prediction} = 0)"),
        "tp": F.expr(f"count_if({label} = 1 AND {prediction} = 1)"),
    }


def confusion(
    predictions: DataFrame,
    keys: Sequence[str],
    label: str = "occupied",
    prediction: str = "pred",
) -> DataFrame:
    counts = _counts(label, prediction)
    return predictions.groupBy(*keys).agg(*[c.alias(n) for n, c in counts.items()])


def confusion_of_predictors(
    predictions: DataFrame,
    keys: Sequence[str],
    predictors: Mapping[str, str],
    label: str = "occupied",
) -> DataFrame:
    """Counts of several prediction columns; ``predictors`` maps report name to column."""
    wide = predictions.groupBy(*keys).agg(
        *[
            F.struct(
                *[c.alias(n) for n, c in _counts(label, column).items()]
            ).alias(f"counts_{column}")
            for column in predictors.values()
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("function"), F.col(f"counts_{column}").alias("counts"))
            for name, column in predictors.items()
        ]
    )
    return wide.withColumn("row", F.explode(rows)).select(
        *keys, "row.function", *[F.col(f"row.counts.{c}").alias(c) for c in COUNTS]
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Add tnr, fpr, fnr and tpr; 0 where a class is absent."""
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    return counts.withColumns(
        {
            "tnr": ratio_or_zero(tn, tn + fp),
            "fpr": ratio_or_zero(fp, tn + fp),
            "fnr": ratio_or_zero(fn, tp + fn),
            "tpr": ratio_or_zero(tp, tp + fn),
        }
    )


def with_scores(counts: DataFrame) -> DataFrame:
    """Add Accuracy, RMSE, F1 and F1 neg."""
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    total = tn + fp + fn + tp
    return counts.withColumns(
        {
            "Accuracy": ratio_or_zero(tp + tn, total),
            "RMSE": F.sqrt(ratio_or_zero(fp + fn, total)),
            "F1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
            "F1 neg": ratio_or_zero(2 * tn, 2 * tn + fp + fn),
        }
    )


def model_metrics(counts: DataFrame) -> DataFrame:
    """All twelve metrics from the four counts; other columns stay."""
    keys = [c for c in counts.columns if c not in COUNTS]
    return with_rates(with_scores(counts)).select(*keys, *DIGITS, *COUNTS)


def to_report_digits(metrics: DataFrame) -> DataFrame:
    """Metrics rounded to their reported significant digits."""
    return metrics.withColumns({m: sig_round(F.col(m), d) for m, d in DIGITS.items()})


def confusion_table(
    predictions: DataFrame,
    keys: Sequence[str],
    label: str = "occupied",
    prediction: str = "pred",
) -> DataFrame:
    """2 x 2 table per key: a row per actual class, a column per predicted class."""
    counts = confusion(predictions, keys, label, prediction)
    rows = F.array(
        F.struct(F.lit("Vacant").alias("actual"), F.col("tn").alias("Vacant"),
                 F.col("fp").alias("Occupied")),
        F.struct(F.lit("Occupied").alias("actual"), F.col("fn").alias("Vacant"),
                 F.col("tp").alias("Occupied")),
    )
    return counts.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")
