"""Time expressions on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_start(ts: Column, bin_minutes: int) -> Column:
    """Left edge of the left-closed bin holding ``ts``."""
    return F.window(ts, f"{bin_minutes} minutes")["start"]


def epoch_minute(ts: str) -> Column:
    """Whole minutes since 1970-01-01, independent of the session time zone."""
    return F.expr(f"unix_date(to_date({ts})) * 1440L + hour({ts}) * 60 + minute({ts})")


def minute_of_day(ts: str) -> Column:
    return F.expr(f"hour({ts}) * 60 + minute({ts})")


def minutes(count: int) -> Column:
    return F.expr(f"INTERVAL '{count}' MINUTE")


def is_weekend(ts: str) -> Column:
    """1 on Saturday and Sunday."""
    return F.expr(f"cast(weekday({ts}) > 4 AS INT)")


def hour_wave(ts: str, wave: str) -> Column:
    """``wave`` (``sin`` or ``cos``) of the hour of day, scaled to 0..1."""
    return F.expr(f"0.5D * {wave}((hour({ts}) + minute({ts}) / 60) * (pi() / 12)) + 0.5D")
