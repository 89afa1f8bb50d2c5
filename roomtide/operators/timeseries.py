"""Binning, gap filling, hub fusion, calendar columns and lags.

Scale notes
-----------
* Raw readings are shuffled only after map-side partial aggregation into bins, so a hub
  holding a third of all readings costs no more shuffle than its bins.
* Gaps are filled inside the same aggregation: the spine of empty bins is unioned to the
  readings, so there is no join and one shuffle.
* Lags run over chunks of consecutive positions.  Every chunk also receives the last rows
  of the chunk before it, which is all a lag can reach, so one long home spreads over
  many tasks and the result equals that of one window per home.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.functions import clock, numeric
from roomtide.runtime import spread
from roomtide.schemas import CHANNELS, N_LAGS, ROWS_PER_LAG

HUB = ("home", "hub")
VALUES = CHANNELS + ("occupied",)
CHUNK_ROWS = 4096


def _value_columns(df: DataFrame) -> list[str]:
    return [c for c in VALUES if c in df.columns]


def to_bins(readings: DataFrame, bin_minutes: int = 5) -> DataFrame:
    """Replace ``ts`` by the start of its bin."""
    return readings.withColumn("ts", clock.bin_start(F.col("ts"), bin_minutes))


def resample(readings: DataFrame, bin_minutes: int = 5) -> DataFrame:
    """Mean of every value column per home, hub and bin; only bins with readings."""
    return (
        to_bins(readings, bin_minutes)
        .groupBy(*HUB, "ts")
        .agg(*[F.avg(c).alias(c) for c in _value_columns(readings)])
    )


def hub_spans(readings: DataFrame, bin_minutes: int = 5) -> DataFrame:
    """One row per hub: its first and last bin and its place in the home's time line.

    ``hub_no`` numbers the hubs of a home by name.  ``seg_start`` and ``seg_offset`` place
    the hub in the fused series of its home: hubs that overlap or touch form one segment,
    and a bin's row position is ``seg_offset`` plus its distance from ``seg_start``.
    """
    spans = (
        to_bins(readings.select(*HUB, "ts"), bin_minutes)
        .groupBy(*HUB)
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .withColumn(
            "hub_no", F.row_number().over(Window.partitionBy("home").orderBy("hub"))
        )
    )
    return place_in_segments(spans, ["home"], bin_minutes)


def place_in_segments(
    spans: DataFrame, series: Sequence[str], bin_minutes: int
) -> DataFrame:
    """Add ``seg_start``, ``seg_end`` and ``seg_offset`` to rows holding a bin range.

    Rows are hub ranges, never readings, so a window per series stays small.
    """
    by_start = Window.partitionBy(*series).orderBy("first_ts", "last_ts", "hub")
    segment = Window.partitionBy(*series, "seg_no")
    reached = F.max("last_minute").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    up_to_here = by_start.rowsBetween(Window.unboundedPreceding, 0)
    seg_rows = f"1 + (seg_last - seg_first) div {bin_minutes}"
    return (
        spans.withColumns(
            {
                "first_minute": clock.epoch_minute("first_ts"),
                "last_minute": clock.epoch_minute("last_ts"),
            }
        )
        .withColumn(
            "opens",
            F.when(F.col("first_minute") <= reached + bin_minutes, 0).otherwise(1),
        )
        .withColumn("seg_no", F.sum("opens").over(up_to_here))
        .withColumns(
            {
                "seg_start": F.min("first_ts").over(segment),
                "seg_end": F.max("last_ts").over(segment),
                "seg_first": F.min("first_minute").over(segment),
                "seg_last": F.max("last_minute").over(segment),
            }
        )
        .withColumn("seg_rows", F.expr(seg_rows))
        .withColumn(
            "seg_offset", F.sum(F.expr("seg_rows * opens")).over(up_to_here) - F.col("seg_rows")
        )
        .drop("opens", "seg_no", "seg_rows", "seg_first", "seg_last", "first_minute", "last_minute")
    )


def position_in(segment: str, bin_minutes: int) -> Column:
    """Row position of ``ts`` from a segment's start and offset columns."""
    start = clock.epoch_minute(f"{segment}seg_start")
    distance = (clock.epoch_minute("ts") - start) / bin_minutes
    return (F.col(f"{segment}seg_offset") + distance).cast("long")


DAY_MINUTES = 24 * 60


def span_days(spans: DataFrame) -> DataFrame:
    """Repeat each span row for every day it touches."""
    days = "explode(sequence(to_date(first_ts), to_date(last_ts), INTERVAL '1' DAY))"
    return spread(spans, *HUB).withColumn("day", F.expr(days))


def spine(spans: DataFrame, bin_minutes: int = 5) -> DataFrame:
    """Every bin between a hub's first and last one, with its row position.

    Bins start at midnight each day, so their width must divide a day.
    """
    if DAY_MINUTES % bin_minutes:
        raise ValueError(f"a bin of {bin_minutes} minutes does not divide a day")
    step = f"INTERVAL '{bin_minutes}' MINUTE"
    first = "greatest(first_ts, cast(day AS TIMESTAMP_NTZ))"
    last = f"least(last_ts, cast(day AS TIMESTAMP_NTZ) + INTERVAL '1' DAY - {step})"
    return (
        span_days(spans)
        .withColumn("ts", F.expr(f"explode(sequence({first}, {last}, {step}))"))
        .select(*HUB, "ts", "hub_no", position_in("", bin_minutes).alias("pos"))
    )


def hub_bins(
    readings: DataFrame, bin_minutes: int = 5, spans: DataFrame | None = None
) -> DataFrame:
    """Gap-filled bins per hub: means, ``pos``, ``hub_no`` and the reading count.

    Bins without readings have NULL values and ``n_readings`` 0.
    """
    spans = hub_spans(readings, bin_minutes) if spans is None else spans
    columns = _value_columns(readings)
    binned = to_bins(readings, bin_minutes).select(
        *HUB, "ts", *columns, F.lit(1).alias("reading")
    )
    return (
        binned.unionByName(spine(spans, bin_minutes), allowMissingColumns=True)
        .groupBy(*HUB, "ts")
        .agg(
            *[F.avg(c).alias(c) for c in columns],
            F.count("reading").alias("n_readings"),
            F.max("pos").alias("pos"),
            F.max("hub_no").alias("hub_no"),
        )
    )


def label_bins(bins: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Occupied where the bin mean reaches the threshold; missing bins are vacant."""
    return bins.withColumn("occupied", numeric.at_least(F.col("occupied"), threshold))


def fill(bins: DataFrame, how: str = "zeros") -> DataFrame:
    """Fill missing channel values by a constant: ``zeros`` or ``ones``."""
    if how not in ("zeros", "ones"):
        raise ValueError(f"unknown fill {how!r}")
    value = 0.0 if how == "zeros" else 1.0
    columns = [c for c in CHANNELS if c in bins.columns]
    return bins.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


def carried_bins(
    readings: DataFrame, bin_minutes: int = 5, spans: DataFrame | None = None
) -> DataFrame:
    """Like :func:`hub_bins`, with the last known value of every channel carried forward.

    Values are carried over the bins that have readings, before any empty bin exists: first
    from day to day, then inside each day.  A bin is then repeated for the empty ones up to the
    next.  Both levels read the same shuffle of aggregated bins, and nothing is stored.
    """
    if DAY_MINUTES % bin_minutes:
        raise ValueError(f"a bin of {bin_minutes} minutes does not divide a day")
    spans = hub_spans(readings, bin_minutes) if spans is None else spans
    columns = _value_columns(readings)
    channels = [c for c in CHANNELS if c in columns]
    known = (
        to_bins(readings, bin_minutes)
        .groupBy(*HUB, "ts")
        .agg(*[F.avg(c).alias(c) for c in columns], F.count("*").alias("n_readings"))
        .withColumn("day", F.to_date("ts"))
    )
    days = Window.partitionBy(*HUB).orderBy("day")
    earlier = days.rowsBetween(Window.unboundedPreceding, -1)
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ts"))).alias(f"last_{c}") for c in channels]
    per_day = known.groupBy(*HUB, "day").agg(F.min("ts").alias("first_of_day"), *last)
    carried = per_day.select(
        *HUB,
        "day",
        F.lead("first_of_day").over(days).alias("next_day"),
        *[F.last(f"last_{c}", ignorenulls=True).over(earlier).alias(f"carry_{c}") for c in channels],
    )
    in_day = Window.partitionBy(*HUB, "day").orderBy("ts")
    so_far = in_day.rowsBetween(Window.unboundedPreceding, 0)
    step = f"INTERVAL '{bin_minutes}' MINUTE"
    full = known.join(carried, [*HUB, "day"]).withColumns(
        {
            **{c: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(f"carry_{c}")) for c in channels},
            "next": F.coalesce(F.lead("ts").over(in_day), F.col("next_day"), F.expr(f"ts + {step}")),
        }
    )
    empty = F.col("at") > 0
    others = [c for c in columns if c not in channels]
    return (
        full.select(*HUB, *columns, "n_readings",
                    F.posexplode(F.expr(f"sequence(ts, next - {step}, {step})")).alias("at", "ts"))
        .withColumns({c: F.when(~empty, F.col(c)) for c in others})
        .withColumn("n_readings", F.when(empty, 0).otherwise(F.col("n_readings")))
        .join(spans.select(*HUB, "hub_no", "seg_start", "seg_offset"), [*HUB])
        .select(*HUB, "ts", *columns, "n_readings", position_in("", bin_minutes).alias("pos"), "hub_no")
    )


def fuse_hubs(bins: DataFrame, keys: Sequence[str] = ("home", "ts")) -> DataFrame:
    """Largest value of every column over the hubs of a home."""
    columns = [*_value_columns(bins), *(c for c in ("pos",) if c in bins.columns)]
    return bins.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def calendar_features(df: DataFrame) -> DataFrame:
    """Add ``day``, ``weekend``, ``hr_sin`` and ``hr_cos``."""
    return df.withColumns(
        {
            "day": F.to_date("ts"),
            "weekend": clock.is_weekend("ts"),
            "hr_sin": clock.hour_wave("ts", "sin"),
            "hr_cos": clock.hour_wave("ts", "cos"),
        }
    )


def with_halo(df: DataFrame, reach: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``chunk`` and repeat each chunk's last ``reach`` rows in the chunk after it.

    Needs gapless positions in ``pos``.
    """
    if chunk_rows < reach:
        raise ValueError("a chunk must hold at least the rows a lag can reach")
    own = F.floor(F.col("pos") / chunk_rows)
    near_end = F.col("pos") % chunk_rows >= chunk_rows - reach
    return df.withColumn(
        "chunk",
        F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))),
    )


def drop_halo(df: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    return df.where(F.col("chunk") == F.floor(F.col("pos") / chunk_rows)).drop("chunk")


def _rolling(window, rows_per_lag: int) -> Column:
    """Rounded mean label of the ``rows_per_lag`` rows before this one."""
    before = window.rowsBetween(-rows_per_lag, -1)
    full = F.count("occupied").over(before) == rows_per_lag
    return F.when(full, F.rint(F.avg("occupied").over(before)))


def lag_columns(
    haloed: DataFrame,
    series: Sequence[str] = ("home",),
    rolling: bool = True,
    n_lags: int = N_LAGS,
    rows_per_lag: int = ROWS_PER_LAG,
) -> DataFrame:
    """Add ``lag1_occupied`` .. over chunks made by :func:`with_halo`.

    Rolling lags are the rounded hourly means before the row; static lags are the label
    exactly ``i`` hours earlier.
    """
    window = Window.partitionBy(*series, "chunk").orderBy("pos")
    if not rolling:
        return haloed.withColumns(
            {
                f"lag{i}_occupied": F.lag("occupied", rows_per_lag * i)
                .over(window)
                .cast("double")
                for i in range(1, n_lags + 1)
            }
        )
    return (
        haloed.withColumn("lag1_occupied", _rolling(window, rows_per_lag))
        .withColumns(
            {
                f"lag{i}_occupied": F.lag("lag1_occupied", rows_per_lag * (i - 1)).over(window)
                for i in range(2, n_lags + 1)
            }
        )
    )


def fused_with_lags(
    bins: DataFrame,
    rolling: bool = True,
    n_lags: int = N_LAGS,
    rows_per_lag: int = ROWS_PER_LAG,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Fuse the hubs and add lags with a single shuffle on (home, chunk)."""
    haloed = with_halo(bins, n_lags * rows_per_lag, chunk_rows).repartition("home", "chunk")
    fused = fuse_hubs(haloed, ("home", "chunk", "ts"))
    lagged = lag_columns(fused, ("home",), rolling, n_lags, rows_per_lag)
    return drop_halo(lagged, chunk_rows)
