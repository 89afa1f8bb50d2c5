"""Thresholds, row maxima and significant-digit rounding."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def at_least(value: Column, threshold: float = 0.5) -> Column:
    """1 where ``value >= threshold``, else 0; NULL counts as below."""
    return F.when(value >= threshold, 1).otherwise(0)


def above(value: Column, threshold: float = 0.5) -> Column:
    """1 where ``value > threshold``, else 0; NULL counts as below."""
    return F.when(value > threshold, 1).otherwise(0)


def row_max(columns: Iterable[str]) -> Column:
    """Largest non-NULL value of a row; NULL only where every column is NULL."""
    columns = list(columns)
    return F.greatest(*columns) if len(columns) > 1 else F.col(columns[0])


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def sigmoid(score: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-score))


def _exponent(value: Column) -> Column:
    return F.floor(F.log10(F.abs(value)))


def sig_round(value: Column, digits: int) -> Column:
    """Round to ``digits`` significant digits."""
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - _exponent(value))
    return F.when(value == 0, F.lit(0.0)).otherwise(F.round(value * scale) / scale)


def sig_str(value: Column, digits: int) -> Column:
    """Text of a number at ``digits`` significant digits: ``0.0``, ``0.92``, ``1e-05``."""
    rounded = sig_round(value, digits)

    def plain(x: Column) -> Column:
        text = F.regexp_replace(x.cast("decimal(30,12)").cast("string"), "0+$", "")
        return F.when(text.endswith("."), F.concat(text, F.lit("0"))).otherwise(text)

    power = _exponent(rounded)
    mantissa = F.regexp_replace(
        plain(F.round(rounded / F.pow(F.lit(10.0), power), digits - 1)), r"\.0$", ""
    )
    tiny = F.concat(
        mantissa, F.lit("e-"), F.lpad((-power).cast("string"), 2, "0")
    )
    return F.when((rounded != 0) & (F.abs(rounded) < 1e-4), tiny).otherwise(plain(rounded))
