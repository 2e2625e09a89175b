"""Accept or quarantine rows without losing any."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import rules


@dataclass(frozen=True)
class Split:
    """Two frames that together hold every input row exactly once."""

    accepted: DataFrame
    rejected: DataFrame


def outcome(reasons: Sequence[tuple[str, Column]], accepted: str = rules.ACCEPTED) -> Column:
    """Name of the first reason that holds, else ``accepted``; never NULL.

    A condition that evaluates to NULL does not hold, so each row has exactly one outcome.
    """
    return F.coalesce(
        *[F.when(condition, F.lit(name)) for name, condition in reasons], F.lit(accepted)
    )


def split(
    df: DataFrame,
    accept: Column,
    reasons: Sequence[tuple[str, Column]],
    judge: Callable[[DataFrame], DataFrame] = lambda df: df,
    column: str = "audit_table",
) -> Split:
    """Rows that ``accept`` holds for, and the others with the first reason that does.

    NULL rejects, and ``reasons`` must name every way of being rejected. ``judge`` adds
    the columns that reasons refer to; it is applied after the rows have parted.
    """
    rejected = judge(df.filter(~F.coalesce(accept, F.lit(False))))
    return Split(judge(df.filter(accept)), rejected.withColumn(column, outcome(reasons)))


def id_reasons(kind: str, valid: Column) -> list[tuple[str, Column]]:
    """The two ways an identifier fails: right shape but wrong length, and no shape at all.

    The second has a NULL flag; taking ``~flag`` alone would lose those rows.
    """
    return [(f"{kind}_invalide", ~valid), (f"{kind}_irreparable", valid.isNull())]


def stamp(df: DataFrame, table: str | None = None, at: Column | None = None) -> DataFrame:
    """Audit reason and date; the reason follows from the audit table's name.

    ``table`` names it for the whole frame, otherwise the column ``audit_table`` does.
    """
    if table is not None:
        df = df.withColumn("audit_table", F.lit(table))
    text = F.coalesce(
        *[F.when(F.col("audit_table") == t, F.lit(r)) for t, r in rules.AUDIT_REASONS.items()]
    )
    return df.withColumns(
        {"audit_reason": text, "audit_date": F.current_timestamp() if at is None else at}
    )
