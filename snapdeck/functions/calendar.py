"""Calendar attributes, ages and status bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapdeck import config
from snapdeck.functions._util import col


def day_of_week_sunday(d: Column | str) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(col(d))


def week_sunday(d: Column | str) -> Column:
    """Week of year with weeks starting on Sunday, 0..53 (days before the first
    Sunday are week 0). Not ISO ``weekofyear``."""
    return F.floor((F.dayofyear(col(d)) + F.lit(7) - F.dayofweek(col(d))) / F.lit(7)).cast("int")


def is_month_start(d: Column | str) -> Column:
    return col(d) == F.trunc(col(d), "MM")


def is_month_end(d: Column | str) -> Column:
    return col(d) == F.last_day(col(d))


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole hours from ``earlier`` to ``later`` (truncated, not boundary-counted)."""
    return F.timestamp_diff("HOUR", col(earlier), col(later))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    return F.timestamp_diff("SECOND", col(earlier), col(later))


def status_band(hours: Column | str, yellow: int = config.BAND_YELLOW_HOURS, red: int = config.BAND_RED_HOURS) -> Column:
    h = col(hours)
    return F.when(h < yellow, "green").when(h < red, "yellow").otherwise("red")


def freshness_status(
    age_seconds: Column | str,
    warn_hours: int = config.FRESH_WARN_HOURS,
    error_hours: int = config.FRESH_ERROR_HOURS,
) -> Column:
    """'pass' / 'warn' / 'error'; an age strictly above a threshold trips it.
    No snapshot at all (NULL age) is an error."""
    a = col(age_seconds)
    return (
        F.when(a.isNull(), "error")
        .when(a > error_hours * 3600, "error")
        .when(a > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
