"""Validity flags. Each states whether NULL counts as false or stays NULL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom import rules


def ticket_id_valid(fixed: Column) -> Column:
    """NULL for an id no repair fits."""
    return fixed.rlike(rules.TICKET_SHAPE)


def fan_id_valid(fixed: Column) -> Column:
    """NULL for an id no repair fits; anonymous fans are valid."""
    return (fixed == rules.ANONYMOUS_FAN) | fixed.rlike(rules.FAN_SHAPE)


def price_valid(price: Column) -> Column:
    """False for NULL."""
    return price.isNotNull() & (price >= 0)


def in_band(label: Column, value: Column, bands: Mapping[str, tuple[int, int]]) -> Column:
    """Whether the value lies in its label's inclusive band; false where undecided."""
    hits = [(label == name) & value.between(low, high) for name, (low, high) in bands.items()]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def in_period(ts: Column, year: int, months: tuple[int, int]) -> Column:
    """NULL for a NULL timestamp."""
    return (F.year(ts) == year) & F.month(ts).between(*months)


def score(flags: Sequence[Column], terms: float) -> Column:
    """Share of true flags in percent of ``terms``; a NULL flag counts as false."""
    return reduce(lambda a, b: a + b, [as_count(f) for f in flags]) / F.lit(terms) * 100


def all_true(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, flags)


def as_count(flag: Column) -> Column:
    return F.coalesce(flag.cast("int"), F.lit(0))
