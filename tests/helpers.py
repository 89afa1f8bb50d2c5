"""Small literal inputs and brute-force versions of operators."""

import datetime as dt

import numpy as np

from roomtide.schemas import CHANNELS, FEATURES, HUB_READINGS

START = dt.datetime(2024, 1, 5)


def readings(spark, rows):
    """``rows``: (home, hub, minute offset, occupied, {channel: value})."""
    data = [
        (
            home,
            hub,
            START + dt.timedelta(minutes=minute),
            *[values.get(c) for c in CHANNELS],
            None if occupied is None else float(occupied),
        )
        for home, hub, minute, occupied, values in rows
    ]
    return spark.createDataFrame(data, HUB_READINGS)


def random_label_readings(spark, bins, seed=3, home="H1", hub="RS1", start_bin=0):
    rng = np.random.default_rng(seed)
    labels = rng.integers(0, 2, bins)
    rows = [(home, hub, 5 * (start_bin + i), int(y), {"audio": 0.1}) for i, y in enumerate(labels)]
    return readings(spark, rows), labels


def rolling_lags(labels, n_lags=8, span=12):
    out = np.full((len(labels), n_lags), np.nan)
    for t in range(len(labels)):
        for i in range(n_lags):
            lo, hi = t - span * i - span, t - span * i
            if lo >= 0:
                out[t, i] = np.round(np.mean(labels[lo:hi]))
    return out


def feature_rows(n, seed=0, noise=1.0):
    """Random feature matrix in model order and labels that depend on it."""
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(FEATURES)))
    x[:, 6] = rng.integers(0, 2, n)
    x[:, 9:] = rng.integers(0, 2, (n, 8))
    score = 3 * x[:, 0] + 2 * x[:, 9] - 1.5 * x[:, 10] + 0.5 * x[:, 6] - 1.8
    y = (score + noise * rng.logistic(size=n) > 0).astype(float)
    return x, y
