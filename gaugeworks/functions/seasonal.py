"""Seasonal encodings of a UTC timestamp."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

HOURS_PER_DAY = 24.0
DAYS_PER_YEAR = 365.25


def seasonal_encodings(ts: Column) -> dict[str, Column]:
    by_hour = F.hour(ts) * F.lit(2 * math.pi / HOURS_PER_DAY)
    by_day = F.dayofyear(ts) * F.lit(2 * math.pi / DAYS_PER_YEAR)
    return {
        "sin_hour": F.sin(by_hour),
        "cos_hour": F.cos(by_hour),
        "sin_doy": F.sin(by_day),
        "cos_doy": F.cos(by_day),
    }
