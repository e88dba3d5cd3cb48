"""Expressions over the event date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotterline.schema import DATE_FORMAT, WEEKEND_DAYS


def event_time(date_text: Column) -> Column:
    """The written date as timestamp, null when it does not match the format exactly."""
    return F.try_to_timestamp(date_text, F.lit(DATE_FORMAT))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_number(ts: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(ts)


def day_name_of(ts: Column) -> Column:
    """English day name, ``Monday`` etc."""
    return F.date_format(ts, "EEEE")


def weekend_flag(day: Column) -> Column:
    """1 on Saturday and Sunday, 0 on other days and for no day."""
    return F.when(day.isin(WEEKEND_DAYS), 1).otherwise(0)


def weekend_text(day: Column, weekend: str, weekday: str) -> Column:
    """One of two texts; a missing day counts as weekday."""
    return F.when(day.isin(WEEKEND_DAYS), F.lit(weekend)).otherwise(F.lit(weekday))
