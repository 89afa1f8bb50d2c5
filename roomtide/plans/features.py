"""From hub readings to model features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.operators import timeseries as ts_ops
from roomtide.operators.predictors import with_time_of_day
from roomtide.operators.splits import assign_split, days_of_spans
from roomtide.runtime import stage
from roomtide.schemas import LAGS


@dataclass(frozen=True)
class Prepared:
    """Hub spans (one row per hub), filled hub bins and fused features."""

    spans: DataFrame
    bins: DataFrame
    features: DataFrame


def prepare(readings: DataFrame, bin_minutes: int = 5, fill: str = "zeros") -> Prepared:
    """Spans are staged: they are small, and days, positions and bins all start from them."""
    spans = stage(ts_ops.hub_spans(readings, bin_minutes))
    bins = filled_bins(readings, bin_minutes, fill, spans)
    lagged = ts_ops.fused_with_lags(bins)
    return Prepared(spans, bins, with_time_of_day(ts_ops.calendar_features(lagged)))


def filled_bins(
    readings: DataFrame,
    bin_minutes: int = 5,
    fill: str = "zeros",
    spans: DataFrame | None = None,
) -> DataFrame:
    """Labelled bins without gaps; ``fill`` is ``zeros``, ``ones`` or ``ffill`` (then zeros)."""
    if fill == "ffill":
        bins, fill = ts_ops.carried_bins(readings, bin_minutes, spans), "zeros"
    else:
        bins = ts_ops.hub_bins(readings, bin_minutes, spans)
    return ts_ops.fill(ts_ops.label_bins(bins), fill)


def complete_rows(features: DataFrame) -> DataFrame:
    """Rows whose lags are all known."""
    return features.dropna(subset=list(LAGS))


def fused_calendar(
    readings: DataFrame, bin_minutes: int = 5, spans: DataFrame | None = None
) -> DataFrame:
    """Fused channels with calendar columns and without lags."""
    fused = ts_ops.fuse_hubs(filled_bins(readings, bin_minutes, spans=spans))
    return with_time_of_day(ts_ops.calendar_features(fused))


def time_of_day_cells(
    readings: DataFrame, bin_minutes: int, split: float = 0.6, days: DataFrame | None = None
) -> DataFrame:
    """Occupied and vacant bins per home, role, weekend flag and time of day.

    All that the lookup predictor needs for training and testing, from one aggregation.
    """
    spans = ts_ops.hub_spans(readings, bin_minutes)
    fused = fused_calendar(readings, bin_minutes, spans)
    roles = assign_split(days_of_spans(spans) if days is None else days, [split])
    return (
        fused.join(roles.select("home", "day", "role"), ["home", "day"])
        .groupBy("home", "weekend", "tod_min")
        .agg(
            *[
                F.count_if((F.col("role") == role) & (F.col("occupied") == y)).alias(f"{role}_{y}")
                for role in ("train", "test")
                for y in (0, 1)
            ]
        )
    )
