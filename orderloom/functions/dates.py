"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def key_year(key: Column) -> Column:
    """Year of a yyyymmdd key."""
    return F.floor(key / 10000).cast("int")
