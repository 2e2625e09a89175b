"""Division as dashboards expect it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column, otherwise: float = 0.0) -> Column:
    """``otherwise`` for a NULL or zero denominator; a NULL numerator stays NULL."""
    unusable = denominator.isNull() | (denominator == 0)
    return F.when(unusable, F.lit(otherwise)).otherwise(numerator / denominator)


def percent(part: Column, total: Column) -> Column:
    return safe_divide(part * 100.0, total)


def capped(value: Column, limit: float = 1.0) -> Column:
    """The value, at most ``limit``; NULL stays NULL."""
    return F.when(value > limit, F.lit(limit)).otherwise(value)
