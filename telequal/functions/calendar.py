"""Calendar parts and cyclic encodings of a timestamp."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_floor(ts: str) -> Column:
    return F.date_trunc("hour", F.col(ts))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole elapsed days, dropping the fraction."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(micros / F.lit(86_400_000_000))


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * value / F.lit(period)
    return F.round(F.sin(angle), 4), F.round(F.cos(angle), 4)


def calendar_features(ts: str, peak: tuple[int, int] = (19, 22)) -> dict[str, Column]:
    """hour, weekday (Monday 0), peak and weekend flags, sine/cosine of hour and weekday."""
    hour, dow = F.hour(F.col(ts)), F.weekday(F.col(ts))
    hour_sin, hour_cos = cyclic(hour, 24)
    dow_sin, dow_cos = cyclic(dow, 7)
    return {
        "hour_of_day": hour,
        "day_of_week": dow,
        "is_peak_hour": F.when(hour.between(*peak), 1).otherwise(0),
        "is_weekend": F.when(dow >= 5, 1).otherwise(0),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "dow_sin": dow_sin,
        "dow_cos": dow_cos,
    }
