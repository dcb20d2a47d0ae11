"""Epoch-millisecond helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def utc_day(ms: Column) -> Column:
    """UTC date of an epoch time, without using the session zone."""
    day = (ms - F.pmod(ms, F.lit(DAY_MS))) / F.lit(DAY_MS)
    return F.date_from_unix_date(day.cast("int"))


def period_start(day: Column, period: str) -> Column:
    """First day of the stored period (``day``, ``month`` or ``year``) that holds a day."""
    return day if period == "day" else F.trunc(day, period)


def period_of_ms(ms: int, period: str) -> dt.date:
    """Plain-Python twin of :func:`period_start` for literal bounds."""
    day = dt.date(1970, 1, 1) + dt.timedelta(days=ms // DAY_MS)
    if period == "year":
        return day.replace(month=1, day=1)
    return day.replace(day=1) if period == "month" else day


def retention_cutoff(now_ms: int, hours: int) -> int:
    return now_ms - hours * HOUR_MS
