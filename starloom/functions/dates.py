"""Calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """yyyyMMdd as an int, computed without formatting a string."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_type(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), "Weekend").otherwise("Weekday")


def at_time(day: Column, clock: Column) -> Column:
    """Date plus HH:MM:SS text; an empty clock text means midnight, unreadable text NULL."""
    return F.try_to_timestamp(F.concat(day.cast("string"), F.lit(" "), clock))
