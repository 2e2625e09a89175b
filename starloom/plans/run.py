"""The full run from bronze to a registered star, one job per stored table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import contracts
from starloom.operators.lasting import LastingKeys
from starloom.operators.profile import observed
from starloom.plans import gold, silver_dims
from starloom.plans import silver_scans as scans_plan
from starloom.rules import ACCEPTED, ScanPolicy
from starloom.session import materialize, removing_intermediates
from starloom.sources.readers import read_table
from starloom.sources.writers import append_run, register_tables, write_table

DIMENSIONS = ("stadiums", "teams", "cities", "matches")
CLEANERS = {
    "stadiums": silver_dims.clean_stadiums,
    "teams": silver_dims.clean_teams,
    "cities": silver_dims.clean_cities,
    "matches": silver_dims.clean_matches,
}


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its layers, and in which format."""

    base: str
    fmt: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        return f"{self.base}/{layer}/{table}"


def run_dimensions(raw: dict[str, DataFrame], layout: Layout) -> dict[str, int]:
    """Clean and store the four silver dimensions."""
    return {
        f"{name}_clean": write_table(
            CLEANERS[name](raw[name]), layout.path("silver", f"{name}_clean"), fmt=layout.fmt
        )
        for name in DIMENSIONS
    }


def run_scans(
    raw: DataFrame,
    matches: DataFrame,
    layout: Layout,
    policy: ScanPolicy | None = None,
    at: Column | None = None,
    run: str | None = None,
) -> dict[str, int]:
    """Classify all scans in one pass, then store the audit and the silver scans from it.

    The raw scans are read more than once, so they should be stored, as bronze is. The classified rows are stored once, without what follows from a row alone. Whatever is read from
    them afterwards agrees on which of several rows was the first, and a lost executor costs a re-read. A named ``run``
    adds its audit to those of other runs, in place of what it added before.
    """
    policy = policy or ScanPolicy()
    placed, seen = observed(
        scans_plan.place_scans(raw, scans_plan.scan_skew(raw, policy), policy, store=True),
        {
            "rows_in": F.sum("count"),
            "rows_distinct": F.count(F.lit(1)),
            "rows_accepted": F.count_if(F.col("audit_table") == ACCEPTED),
        },
    )
    stored = scans_plan.told_scans(materialize(placed, "classified"), policy)
    metrics = dict(seen.get)
    audit, kept = scans_plan.audit_of(stored, at), layout.path("audit", "rejected_scans")
    how = {"fmt": layout.fmt, "partition_by": ["audit_table"], "few": True}
    metrics["audit"] = write_table(audit, kept, **how) if run is None else append_run(audit, kept, run, **how)
    accepted = scans_plan.accepted_of(stored)
    metrics["scan_quality"] = write_table(
        accepted.select(F.col("ticket_id_fixed").alias("ticket_id"), *scans_plan.QUALITY),
        layout.path("silver", "scan_quality"),
        fmt=layout.fmt,
    )
    silver = scans_plan.enrich_scans(scans_plan.cleaned_columns(accepted), matches, policy)
    metrics["ticket_scans_clean"] = write_table(
        silver, layout.path("silver", "ticket_scans_clean"), fmt=layout.fmt
    )
    return metrics


def run_gold(
    spark: SparkSession,
    layout: Layout,
    at: Column | None = None,
    policy: ScanPolicy | None = None,
    run: str | None = None,
) -> dict[str, int]:
    """Build and store the star from the stored silver tables.

    A named ``run`` keeps the surrogate keys of earlier runs and only adds to them.
    """
    silver = {
        name: read_table(spark, layout.path("silver", f"{name}_clean"), layout.fmt)
        for name in DIMENSIONS
    }
    silver["scans"] = read_table(spark, layout.path("silver", "ticket_scans_clean"), layout.fmt)
    lasting = LastingKeys(f"{layout.base}/keys", run) if run else None
    star = gold.build_star(silver, at, policy, lasting)
    return {
        name: write_table(
            contracts.assert_contract(table, contracts.GOLD[name]),
            layout.path("gold", name),
            fmt=layout.fmt,
            partition_by=["scan_day"] if name == "fact_ticket_scan" else (),
        )
        for name, table in star.items()
    }


def read_star(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The stored star; the fact's partition column stays text."""
    return {
        name: read_table(
            spark, layout.path("gold", name), layout.fmt, text_columns=["scan_day"]
        ).select(*schema.names)
        for name, schema in contracts.GOLD.items()
    }


def register_star(spark: SparkSession, layout: Layout, database: str = "gold") -> DataFrame:
    """Catalog entries over the stored star."""
    tables = {name: layout.path("gold", name) for name in contracts.GOLD}
    location = layout.path("catalog", database)
    return register_tables(
        spark, database, tables, layout.fmt, location, partitioned=["fact_ticket_scan"]
    )


def run_all(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    layout: Layout,
    policy: ScanPolicy | None = None,
    at: Column | None = None,
    run: str | None = None,
) -> dict[str, int]:
    """Bronze frames (scans and the four dimensions) to a stored star; returns row counts.

    ``run`` names the run: its audit replaces only its own, and surrogate keys last from run
    to run. Tables stored on the way are removed once everything is written.
    """
    with removing_intermediates(spark):
        counts = run_dimensions(raw, layout)
        matches = read_table(spark, layout.path("silver", "matches_clean"), layout.fmt)
        counts.update(run_scans(raw["scans"], matches, layout, policy, at, run))
        counts.update(run_gold(spark, layout, at, policy, run))
    return counts
