"""Day lists and day-ordered train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.operators.timeseries import span_days
from roomtide.sources.config import ordered_days


def days_of_spans(spans: DataFrame) -> DataFrame:
    """Distinct days per home covered by its hubs, straight from the span table."""
    return span_days(spans).select("home", "day").distinct()


def assign_split(days: DataFrame, splits: Sequence[float] = (0.6,)) -> DataFrame:
    """First ``floor(n_days * split)`` days of a home train, the others test.

    One row per home, day and split ratio.
    """
    ratios = F.array(*[F.lit(float(s)) for s in splits])
    early = F.col("day_no") <= F.floor(F.col("n_days") * F.col("split"))
    return (
        ordered_days(days)
        .withColumn("split", F.explode(ratios))
        .withColumn("role", F.when(early, "train").otherwise("test"))
    )


def with_directions(split_days: DataFrame) -> DataFrame:
    """Repeat the split with train and test swapped: ``normal`` and ``reverse``."""
    swapped = F.when(F.col("role") == "train", "test").otherwise("train")
    both = F.array(
        F.struct(F.lit("normal").alias("direction"), F.col("role")),
        F.struct(F.lit("reverse").alias("direction"), swapped.alias("role")),
    )
    return split_days.withColumn("use", F.explode(both)).select(
        *[c for c in split_days.columns if c != "role"], "use.direction", "use.role"
    )


def keep_days(df: DataFrame, days: DataFrame) -> DataFrame:
    """Rows whose home and day are listed."""
    return df.join(days.select("home", "day"), ["home", "day"], "left_semi")


def common_days(available: DataFrame, wanted: DataFrame) -> DataFrame:
    """Days both lists hold."""
    return available.select("home", "day").intersect(wanted.select("home", "day"))


def awake_only(inferences: DataFrame, sleep_start: str, sleep_end: str) -> DataFrame:
    """Leave out samples with ``sleep_start <= time of day < sleep_end``."""
    time = F.col("hr_min_sec")
    return inferences.where(~((time >= sleep_start) & (time < sleep_end)))
