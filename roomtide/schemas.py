"""Column sets and schemas shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Channel and feature names, in the order models list them.
ENV = ("temp", "rh", "light", "co2eq")
CHANNELS = ("audio", "img") + ENV
N_LAGS = 8
ROWS_PER_LAG = 12
LAGS = tuple(f"lag{i}_occupied" for i in range(1, N_LAGS + 1))
EXOGENOUS = (
    "audio", "co2eq", "light", "rh", "temp", "img", "weekend", "hr_sin", "hr_cos",
)
FEATURES = EXOGENOUS + LAGS
# Order in which coefficient reports list their rows.
TERM_ORDER = (
    "C", "Intercept", "audio", "img", "temp", "rh", "light", "co2eq",
    "weekend", "hr_cos", "hr_sin",
) + LAGS
# Metrics that take part in effect tables.
EFFECT_METRICS = (
    "Accuracy", "F1", "F1 neg", "tnr", "fpr", "fnr", "tpr", "tn", "fp", "fn", "tp",
)
NO_CHANNEL = "None"


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


HUB_CSV = _struct(
    timestamp=T.TimestampNTZType(),
    **{c: T.DoubleType() for c in CHANNELS},
    occupied=T.DoubleType(),
)
HUB_READINGS = _struct(
    home=T.StringType(),
    hub=T.StringType(),
    ts=T.TimestampNTZType(),
    **{c: T.DoubleType() for c in CHANNELS},
    occupied=T.DoubleType(),
)
INFERENCES = _struct(
    home=T.StringType(),
    hub=T.StringType(),
    day=T.DateType(),
    hr_min_sec=T.StringType(),
    audio=T.IntegerType(),
    img=T.IntegerType(),
    occupied=T.IntegerType(),
)
METRICS = _struct(
    **{"function": T.StringType(), "Accuracy": T.DoubleType(), "RMSE": T.DoubleType(),
       "F1": T.DoubleType(), "F1 neg": T.DoubleType(),
       "tnr": T.DoubleType(), "fpr": T.DoubleType(), "fnr": T.DoubleType(),
       "tpr": T.DoubleType(), "tn": T.LongType(), "fp": T.LongType(),
       "fn": T.LongType(), "tp": T.LongType()}
)
COEFFICIENTS = _struct(
    train_home=T.StringType(), term=T.StringType(), value=T.DoubleType()
)
