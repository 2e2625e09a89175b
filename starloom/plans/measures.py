"""Dashboard measures over the star, one row per group of a visual."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import rules
from starloom.functions.numbers import capped, safe_divide
from starloom.operators.lookup import lookup_join
from starloom.operators.skew import HotKeys

# Roles the dimensions play for the fact: stored dimension, fact column, dimension key.
ROLES = {
    "dim_stadium": ("dim_stadium", "stadium_key", "stadium_key"),
    "dim_match": ("dim_match", "match_key", "match_key"),
    "dim_time": ("dim_time", "date_key", "date_key"),
    "dim_fan": ("dim_fan", "fan_key", "fan_key"),
    "home_team": ("dim_team", "home_team_key", "team_key"),
    "away_team": ("dim_team", "away_team_key", "team_key"),
}


def is_scanned() -> Column:
    """Attended scans; text compares without regard to case."""
    return F.upper("scan_status") == rules.SCANNED


def tickets(fact: DataFrame, *by: str) -> DataFrame:
    """Scanned tickets per group."""
    return fact.groupBy(*by).agg(F.count_if(is_scanned()).alias("tickets"))


def with_attributes(
    rows: DataFrame,
    star: Mapping[str, DataFrame],
    attributes: Mapping[str, tuple[str, str]],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add dimension attributes, named ``{new name: (role, attribute)}``.

    ``hot``: no oversize groups (``HotKeys()``) where ``rows`` are already one per key.
    """
    by_role: dict[str, dict[str, str]] = {}
    for name, (role, attribute) in attributes.items():
        by_role.setdefault(role, {})[name] = attribute
    for role, wanted in by_role.items():
        dim, fact_key, dim_key = ROLES[role]
        side = star[dim].select(
            F.col(dim_key).alias("__dim_key"),
            *[F.col(attribute).alias(name) for name, attribute in wanted.items()],
        )
        rows = lookup_join(rows, side, {"__dim_key": F.col(fact_key)}, hot=hot)
    return rows


def occurring(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Members of a dimension that the fact refers to: the filter running both ways.

    The fact is reduced to its distinct keys first, so the semi join never sees its rows.
    """
    return dim.join(fact.select(key).distinct(), key, "left_semi")


def fill_rates(
    fact: DataFrame,
    star: Mapping[str, DataFrame],
    by: Sequence[str] = (),
    attributes: Mapping[str, tuple[str, str]] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Scanned tickets, capacity and fill rate per group.

    ``by`` lists fact columns, ``attributes`` dimension columns to group by as well, and
    ``where`` filters the fact. Capacity is the largest among the stadiums that the
    group's rows refer to. The fact is aggregated once to its group keys and the
    dimensions are joined to that, so its rows are shuffled in partial sums only.
    """
    attributes = dict(attributes or {})
    if where is not None:
        fact = fact.filter(where)
    fact_keys = [ROLES[role][1] for role, _ in attributes.values()]
    level = list(dict.fromkeys([*by, *fact_keys, "stadium_key"]))
    seats = {"seating_capacity": ("dim_stadium", "seating_capacity")}
    counted = tickets(fact, *level)
    described = with_attributes(counted, star, {**attributes, **seats}, HotKeys())
    grouped = described.groupBy(*by, *attributes).agg(
        F.sum("tickets").alias("tickets"), F.max("seating_capacity").alias("capacity")
    )
    rate = safe_divide(F.col("tickets"), F.col("capacity"))
    return grouped.withColumn("fill_rate", rate)


def fill_rate_slices(
    fact: DataFrame,
    star: Mapping[str, DataFrame],
    slices: Sequence[Sequence[str]],
    attributes: Mapping[str, tuple[str, str]] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Tickets, capacity and fill rate for several groupings in one pass over the fact.

    ``slices`` lists the groupings, by fact columns or names in ``attributes``; an empty one is the
    total. A row has NULL in the columns its grouping lacks, and ``slice``, the grouping id over
    all columns in order of first mention, tells these from NULLs of the data. The fact is aggregated once
    to the keys that all groupings together need, then each of those rows counts in every grouping.
    """
    attributes = dict(attributes or {})
    columns = list(dict.fromkeys(c for one in slices for c in one))
    if where is not None:
        fact = fact.filter(where)
    by = [c for c in columns if c not in attributes]
    fact_keys = [ROLES[role][1] for role, _ in attributes.values()]
    counted = tickets(fact, *dict.fromkeys([*by, *fact_keys, "stadium_key"]))
    seats = {"seating_capacity": ("dim_stadium", "seating_capacity")}
    described = with_attributes(counted, star, {**attributes, **seats}, HotKeys())
    grouped = described.groupingSets([[F.col(c) for c in one] for one in slices], *columns).agg(
        F.grouping_id().alias("slice"),
        F.sum("tickets").alias("tickets"),
        F.max("seating_capacity").alias("capacity"),
    )
    return grouped.withColumn("fill_rate", safe_divide(F.col("tickets"), F.col("capacity")))


def distinct_tickets(fact: DataFrame, *by: str, count_null: bool = False) -> DataFrame:
    """Distinct ticket ids per group; ``count_null`` counts a missing id as one more."""
    found = F.count_distinct("ticket_id")
    if count_null:
        found = found + F.coalesce(F.max(F.col("ticket_id").isNull().cast("int")), F.lit(0))
    return fact.groupBy(*by).agg(found.alias("tickets_sold"))


def fill_gauge(
    fact: DataFrame,
    dim_stadium: DataFrame,
    matches: int = rules.TOURNAMENT_MATCHES,
    stadiums: int = rules.TOURNAMENT_STADIUMS,
    by_stadium: bool = False,
    count_null: bool = False,
) -> DataFrame:
    """Share of all seats sold over the tournament, at most 1; one row, or one per stadium.

    Seats are the summed capacities of the stadiums times matches per stadium.
    """
    group = ["stadium_key"] if by_stadium else []
    sold = distinct_tickets(fact, *group, count_null=count_null)
    seats = dim_stadium.groupBy(*group).agg(
        (F.sum("seating_capacity") * (matches / stadiums)).alias("total_capacity")
    )
    # Both hold one row per stadium, or one row: put them side by side without a join.
    both = (
        sold.unionByName(seats, allowMissingColumns=True)
        .groupBy(*group)
        .agg(*[F.max(c).alias(c) for c in ("tickets_sold", "total_capacity")])
        .filter(F.col("tickets_sold").isNotNull())
    )
    share = safe_divide(F.col("tickets_sold"), F.col("total_capacity"))
    return both.withColumn("gauge", capped(share))
