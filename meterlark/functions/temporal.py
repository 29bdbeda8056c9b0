"""Calendar columns of a timestamp without time zone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from meterlark import params
from meterlark.errors import DataValidationError


def weekday(ts: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def is_weekend(day: Column) -> Column:
    return day.isin(5, 6).cast("int")


def is_rush_hour(hour: Column, rush_hours=params.RUSH_HOURS) -> Column:
    """1 when the hour lies in one of the ranges, both ends included."""
    hit = F.lit(False)
    for first, last in rush_hours:
        hit = hit | hour.between(first, last)
    return hit.cast("int")


def cyclic(x: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of ``x`` as an angle on a circle of ``period`` steps."""
    angle = x * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def floor_hour(ts: Column) -> Column:
    """Start of the hour, kept free of time zones (date_trunc alone returns a zoned type)."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Fractional seconds from start to end."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def hours_before(ts: Column, hours: int) -> Column:
    return F.timestamp_add("HOUR", F.lit(-hours), ts)


def hours_after(ts: Column, hours: int) -> Column:
    return F.timestamp_add("HOUR", F.lit(hours), ts)


def hourly_range(first: Column, last: Column) -> Column:
    """All hours from first to last, both included, as an array."""
    return F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))


def with_temporal_features(df: DataFrame, rush_hours=params.RUSH_HOURS) -> DataFrame:
    """Eight calendar columns of ``pickup_datetime``."""
    if "pickup_datetime" not in df.columns:
        raise DataValidationError("temporal features need the column 'pickup_datetime'")
    hour, day = F.hour("pickup_datetime"), weekday(F.col("pickup_datetime"))
    hour_sin, hour_cos = cyclic(hour, 24)
    day_sin, day_cos = cyclic(day, 7)
    return df.withColumns(
        {
            "pickup_hour": hour,
            "pickup_weekday": day,
            "pickup_is_weekend": is_weekend(day),
            "pickup_is_rush_hour": is_rush_hour(hour, rush_hours),
            "pickup_hour_sin": hour_sin,
            "pickup_hour_cos": hour_cos,
            "pickup_weekday_sin": day_sin,
            "pickup_weekday_cos": day_cos,
        }
    )


def with_calendar(df: DataFrame, ts: str = "hour") -> DataFrame:
    """Seven calendar columns of a grid hour."""
    hour, day = F.hour(ts), weekday(F.col(ts))
    hour_sin, hour_cos = cyclic(hour, 24)
    day_sin, day_cos = cyclic(day, 7)
    return df.withColumns(
        {
            "hour_of_day": hour,
            "day_of_week": day,
            "is_weekend": is_weekend(day),
            "hour_of_day_sin": hour_sin,
            "hour_of_day_cos": hour_cos,
            "day_of_week_sin": day_sin,
            "day_of_week_cos": day_cos,
        }
    )
