"""Occupancy predictors: channel OR, time-of-day lookup, regression and its rollout."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.functions import clock, numeric
from roomtide.schemas import ENV, EXOGENOUS, FEATURES, LAGS, ROWS_PER_LAG

OR_CHANNELS = {"ai": ("audio", "img"), "aie": ("audio", "img", *ENV)}


def or_baseline(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add ``prob``/``pred`` columns of the two OR predictors; the cut is strict."""
    for name, channels in OR_CHANNELS.items():
        df = df.withColumn(f"prob_{name}", numeric.row_max(channels))
        df = df.withColumn(f"pred_{name}", numeric.above(F.col(f"prob_{name}"), threshold))
    return df


def with_time_of_day(df: DataFrame) -> DataFrame:
    return df.withColumn("tod_min", clock.minute_of_day("ts"))


def time_of_day_model(train: DataFrame, keys: Sequence[str] = ("home",)) -> DataFrame:
    """Mean occupancy per key, weekend flag and time of day."""
    return train.groupBy(*keys, "weekend", "tod_min").agg(F.avg("occupied").alias("prob_np"))


def time_of_day_predict(
    test: DataFrame, model: DataFrame, keys: Sequence[str] = ("home",), threshold: float = 0.5
) -> DataFrame:
    """Look up the probability; times the model has not seen are vacant."""
    found = test.join(model, [*keys, "weekend", "tod_min"], "left")
    return found.withColumn("pred_np", numeric.at_least(F.col("prob_np"), threshold))


def linear_score(intercept: Column, weights: Mapping[str, Column]) -> Column:
    """Intercept plus weighted columns; ``weights`` maps a column name to its weight."""
    score = intercept
    for name, weight in weights.items():
        score = score + weight * F.col(name)
    return score


def coefficient(term: str, coefficients: str = "coef") -> Column:
    """Weight of a term in the array column made by the trainer (intercept last)."""
    position = len(FEATURES) if term == "Intercept" else FEATURES.index(term)
    return F.col(coefficients)[position]


def score_true_lags(df: DataFrame, coefficients: str = "coef") -> DataFrame:
    """Add ``prob_gt``/``pred_gt``: the regression fed with the true lags; null where one is unknown."""
    score = linear_score(
        coefficient("Intercept", coefficients),
        {f: coefficient(f, coefficients) for f in FEATURES},
    )
    scored = df.withColumn("prob_gt", numeric.sigmoid(score))
    pred = F.when(F.col("prob_gt").isNotNull(), numeric.above(F.col("prob_gt")))
    return scored.withColumn("pred_gt", pred)


def rollout_input(
    df: DataFrame, coefficients: str = "coef", rows_per_lag: int = ROWS_PER_LAG
) -> DataFrame:
    """Add ``base``: the part of the score that does not depend on earlier predictions.

    Until row ``rows_per_lag * (j + 1)`` of a series, lag ``j + 1`` is still the true one.
    ``series_pos`` is the row's position in its series.
    """
    score = linear_score(
        coefficient("Intercept", coefficients),
        {f: coefficient(f, coefficients) for f in EXOGENOUS},
    )
    for j, lag in enumerate(LAGS):
        early = F.col("series_pos") < rows_per_lag * (j + 1)
        score = score + F.when(early, coefficient(lag, coefficients) * F.col(lag)).otherwise(0.0)
    first = F.col("series_pos") == 0
    weights = F.when(first, F.array(*[coefficient(lag, coefficients) for lag in LAGS]))
    return df.withColumns({"base": score, "lag_weights": weights})


def place_series(lengths: DataFrame, tasks: int, together: int = 100_000) -> DataFrame:
    """series_id, ``task`` and ``slot`` (its number in the task) of every series.

    ``lengths``: series_id, n (rows).  Series are dealt to the tasks by length, the longest first,
    there and back, so tasks differ by about one series and hold about as many rows each.  More
    than ``together`` series are dealt in several hands, none of which meets another.
    """
    hands = lengths.count() // together + 1
    hand = F.pmod(F.xxhash64("series_id"), F.lit(hands)).cast("int")
    order = Window.partitionBy("hand").orderBy(F.col("n").desc(), "series_id")
    dealt = lengths.withColumn("hand", hand).withColumn("number", F.row_number().over(order) - 1)
    turn = F.floor(F.col("number") / tasks).cast("int")
    place = F.col("number") % tasks
    there = F.when(turn % 2 == 0, place).otherwise(tasks - 1 - place)
    return dealt.select("series_id", ((there + F.col("hand")) % tasks).cast("int").alias("task"),
                        (turn * hands + F.col("hand")).cast("int").alias("slot"))


class _InStep:
    """The last probabilities of all series of a task, which advance one position at a time.

    ``recent`` is a ring over positions, written twice, so that the rows before any position
    stand together: window k of ``rows_per_lag`` rows back from there is lag k + 1.
    """

    def __init__(self, rows_per_lag: int) -> None:
        self.rows_per_lag = rows_per_lag
        self.weights = np.zeros((0, 0))
        self.recent = np.zeros((0, 0))

    def admit(self, slots: np.ndarray, weights: np.ndarray) -> None:
        """Series that begin; ``weights``: their lag weights, a row each."""
        reach = self.rows_per_lag * weights.shape[1]
        more = max(0, int(slots.max()) + 1 - self.weights.shape[1])
        if more:
            more = max(more, self.weights.shape[1])
            self.weights = np.hstack([self.weights.reshape(weights.shape[1], -1), np.zeros((weights.shape[1], more))])
            self.recent = np.hstack([self.recent.reshape(2 * reach, -1), np.zeros((2 * reach, more))])
        self.weights[:, slots] = weights.T

    def advance(self, position: int, slots: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Probabilities of the rows of one position; a lag counts once all its rows are known."""
        n_lags, span = len(self.weights), self.rows_per_lag
        reach = n_lags * span
        at, full = position % reach, min(n_lags, position // span)
        score = base
        if full:
            before = self.recent[at + reach - full * span : at + reach][:, slots]
            means = before.reshape(full, span, -1).sum(axis=1)[::-1] / span
            score = base + (self.weights[:full, slots] * means).sum(axis=0)
        prob = 1.0 / (1.0 + np.exp(-np.clip(score, -700.0, 700.0)))
        self.recent[at, slots] = self.recent[at + reach, slots] = prob
        return prob


def rollout(
    df: DataFrame, series: str = "series_id", rows_per_lag: int = ROWS_PER_LAG
) -> DataFrame:
    """Add ``prob_ar``/``pred_ar``: the regression fed with its own probabilities.

    Input is :func:`rollout_input`; ``task`` and ``slot`` of :func:`place_series` are used if
    there, else series are counted and placed here.  A task gets its series in order of
    position and advances all of them together; it keeps the last ``rows_per_lag * 8``
    probabilities of each, never a whole series.  The recurrence makes a series sequential,
    and a series is bounded by the number of bins in its days.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if "task" not in df.columns:
        lengths = df.groupBy(F.col(series).alias("series_id")).agg(F.count("*").alias("n"))
        placed = place_series(lengths, tasks).withColumnRenamed("series_id", series)
        df = df.join(placed, series)
    schema = df.drop("base", "lag_weights", "task", "slot").withColumn("prob_ar", F.lit(0.0)).schema
    kept = [f.name for f in schema if f.name != "prob_ar"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _InStep(rows_per_lag)
        for batch in batches:
            position = batch.column("series_pos").to_numpy(zero_copy_only=False)
            slots = batch.column("slot").to_numpy()
            base = batch.column("base").to_numpy(zero_copy_only=False)
            begins = position == 0
            if begins.any():
                weights = batch.column("lag_weights").filter(pa.array(begins)).flatten().to_numpy()
                state.admit(slots[begins], weights.reshape(int(begins.sum()), -1))
            out = np.empty(len(base))
            edges = [0, *(np.flatnonzero(position[1:] != position[:-1]) + 1).tolist(), len(position)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                if hi > lo:
                    out[lo:hi] = state.advance(int(position[lo]), slots[lo:hi], base[lo:hi])
            columns = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(out)], names=[*kept, "prob_ar"]
            )

    ordered = df.repartitionById(tasks, "task").sortWithinPartitions("series_pos", "slot")
    return ordered.mapInArrow(run, schema).withColumn(
        "pred_ar", numeric.above(F.col("prob_ar"))
    )
