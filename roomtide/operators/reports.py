"""Report views: pivots, labels and coefficient summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.functions.numeric import sig_str
from roomtide.schemas import TERM_ORDER

# Fixed value: number of homes in the error estimate of the published coefficient plot.
HOMES_IN_ERROR = 6


def _single(value: Column) -> Column:
    """The only value of a pivot cell; more than one is an error."""
    return F.when(
        F.count(value) > 1, F.raise_error(F.lit("several rows for one pivot cell"))
    ).otherwise(F.max(value))


def pivot_train_test(
    metrics: DataFrame, function: str, metric: str, homes: Sequence[str]
) -> DataFrame:
    """Train homes down, test homes across, one metric of one predictor."""
    rows = metrics.where(F.col("function") == function).select(
        "train", "test", F.col(f"`{metric}`").alias("cell")
    )
    cells = rows.groupBy("train").agg(
        *[_single(F.when(F.col("test") == h, F.col("cell"))).alias(h) for h in homes]
    )
    return cells.orderBy("train")


def with_f1_label(metrics: DataFrame) -> DataFrame:
    """``F1s``: both F1 scores as text, two significant digits each."""
    return metrics.withColumn(
        "F1s", F.concat_ws(" / ", sig_str(F.col("F1"), 2), sig_str(F.col("`F1 neg`"), 2))
    )


def cross_home_order(metrics: DataFrame) -> DataFrame:
    """Predictor ascending, own-home rows before cross-home rows."""
    return metrics.orderBy(F.col("function").asc(), F.col("self/cross").desc(), "train", "test")


def split_order(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(
        F.col("home").asc(), F.col("function").desc(), F.col("split").asc(),
        F.col("direction").asc(),
    )


def _term_rank() -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in TERM_ORDER]), F.col("term"))


def term_order(coefficients: DataFrame) -> DataFrame:
    """Sort by the report order of terms; unknown terms last."""
    rank = _term_rank()
    return coefficients.orderBy(F.when(rank == 0, None).otherwise(rank).asc_nulls_last(), "term")


def coefficient_summary(
    coefficients: DataFrame,
    leave_out_homes: Sequence[str] = (),
    compat: bool = False,
) -> DataFrame:
    """Spread of every term over the homes.

    By default all statistics are over homes.  ``compat`` reproduces the published table:
    its median also counts the mean, and its ``stdev`` also counts the mean, median,
    minimum, maximum and the four distances.
    """
    rows = coefficients.where(
        (F.col("term") != "cv") & ~F.col("train_home").isin(*leave_out_homes)
        if leave_out_homes
        else F.col("term") != "cv"
    ).select("term", F.col("value").cast("double").alias("value"))
    base = rows.groupBy("term").agg(
        F.avg("value").alias("mean"),
        F.median("value").alias("med"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.stddev_samp("value").alias("stdev"),
        F.count("value").alias("n"),
        F.sum("value").alias("total"),
        F.sum(F.col("value") * F.col("value")).alias("squares"),
    )
    if compat:
        means = base.select("term", F.col("mean").alias("value"))
        with_mean = rows.unionByName(means).groupBy("term").agg(F.median("value").alias("med"))
        base = base.drop("med").join(with_mean, "term")
    distances = base.withColumns(
        {
            "lbMed": F.col("med") - F.col("min"),
            "ubMed": F.col("max") - F.col("med"),
            "lbMean": F.col("mean") - F.col("min"),
            "ubMean": F.col("max") - F.col("mean"),
        }
    )
    if compat:
        extra = ("mean", "med", "min", "max", "lbMed", "ubMed", "lbMean", "ubMean")
        total, squares = F.col("total"), F.col("squares")
        for c in extra:
            total, squares = total + F.col(c), squares + F.col(c) * F.col(c)
        count = F.col("n") + len(extra)
        spread = F.greatest((squares - total * total / count) / (count - 1), F.lit(0.0))
        distances = distances.withColumn("stdev", F.sqrt(spread))
    error = F.col("mean") - 1.96 * F.col("stdev") / F.sqrt(F.lit(float(HOMES_IN_ERROR)))
    return distances.select(
        "term", "mean", "med", "min", "max", "lbMed", "ubMed", "lbMean", "ubMean", "stdev",
        error.alias("errors"),
    )


def join_cv_summary(summary: DataFrame, cv_summary: DataFrame) -> DataFrame:
    """Both summaries side by side, the cross-validated one with suffix ``_cv``."""
    columns = ("mean", "errors", "med", "min", "max", "lbMean", "ubMean", "lbMed", "ubMed")
    other = cv_summary.select("term", *[F.col(c).alias(f"{c}_cv") for c in columns])
    return summary.select("term", *columns).join(other, "term", "left")


def coefficients_by_home(coefficients: DataFrame, homes: Sequence[str]) -> DataFrame:
    """A row per term, a column per home."""
    return coefficients.groupBy("term").agg(
        *[F.max(F.when(F.col("train_home") == h, F.col("value"))).alias(h) for h in homes]
    )


def daily_occupancy(features: DataFrame, split_days: DataFrame) -> DataFrame:
    """Share of occupied bins per home, day and role in the split."""
    per_day = features.groupBy("home", "day").agg(F.avg("occupied").alias("occupied"))
    return per_day.join(split_days.select("home", "day", "role"), ["home", "day"])
