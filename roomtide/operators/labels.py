"""Replacing hub labels by per-person ground truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.functions.numeric import row_max

TRUTH_KEYS = ("home", "ts", "occupied")


def household_truth(truth: DataFrame) -> DataFrame:
    """``occ_max``: 1 where any person is present."""
    persons = [c for c in truth.columns if c not in TRUTH_KEYS]
    return truth.select("home", "ts", row_max(persons).alias("occ_max"))


def match_truth(readings: DataFrame, truth: DataFrame) -> DataFrame:
    """Readings that have ground truth at their timestamp, with ``occ_max`` added."""
    return readings.join(household_truth(truth), ["home", "ts"])


def relabel(matched: DataFrame) -> DataFrame:
    return matched.withColumn("occupied", F.col("occ_max").cast("double")).drop("occ_max")


def label_difference(matched: DataFrame) -> DataFrame:
    """``diff``: new label minus old one, per hub reading."""
    return matched.select("home", "hub", "ts", (F.col("occ_max") - F.col("occupied")).alias("diff"))


def label_difference_wide(matched: DataFrame, hubs: Sequence[str]) -> DataFrame:
    """One row per home and timestamp, one difference column per hub."""
    return (
        label_difference(matched)
        .groupBy("home", "ts")
        .pivot("hub", list(hubs))
        .agg(F.max("diff"))
    )
