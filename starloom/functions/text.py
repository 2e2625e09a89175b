"""Text clean-up: named cleaners applied to many columns in one projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Cleaner = Callable[[Column], Column]


def trimmed(c: Column) -> Column:
    return F.trim(c)


def code(c: Column) -> Column:
    """Identifier or code: no outer blanks, upper case."""
    return F.upper(F.trim(c))


def title(c: Column) -> Column:
    """Proper name: no outer blanks, each word capitalised."""
    return F.initcap(F.trim(c))


def address(c: Column) -> Column:
    """Mail address: no outer blanks, lower case."""
    return F.lower(F.trim(c))


def without_blanks(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", "")


def clock_time(c: Column) -> Column:
    """The HH:MM:SS inside a longer text, '' where there is none."""
    return F.regexp_extract(c, r"\d{2}:\d{2}:\d{2}", 0)


def code_or(c: Column, default: str) -> Column:
    """``code`` with a text standing for NULL."""
    return F.coalesce(code(c), F.lit(default))


def clean(df: DataFrame, cleaners: Mapping[str, Cleaner]) -> DataFrame:
    """Apply one cleaner per column; the other columns and the order stay."""
    return df.withColumns({name: cleaner(F.col(f"`{name}`")) for name, cleaner in cleaners.items()})
