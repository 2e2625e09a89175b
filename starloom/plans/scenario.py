"""Raw ticket tables derived from the order tables the driver provides.

They cover every repair branch, NULL and duplicate ids across spellings, late purchases,
missing references that can and cannot be filled, stadiums without a city or without a
visitor, matches without a stadium or a team, and several matches at one stadium on one
day. Each row of ``lineitem`` gives one scan, each of ``orders`` a match, each of
``supplier`` a stadium, so work and lookups grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom import contracts

_SERIAL = "(l_orderkey * 10 + l_linenumber)"
#: The stadium of an order: customers are spread over as many stadiums as there are suppliers,
#: a thirteenth of which nobody visits.
_NEAR = "CAST(floor(o_custkey / 15) AS BIGINT)"
SITE = f"(CASE WHEN {_NEAR} % 13 = 7 THEN {_NEAR} - 1 ELSE {_NEAR} END)"
LINE = (
    f"""CASE WHEN l_suppkey % 50 = 7 THEN NULL ELSE CASE CAST(l_partkey % 8 AS INT)
        WHEN 0 THEN 'TICKET_' || {_SERIAL} WHEN 1 THEN 'ticket_' || {_SERIAL}
        WHEN 2 THEN 'TK_' || {_SERIAL} WHEN 3 THEN 'TICKET' || {_SERIAL}
        WHEN 4 THEN '  Ticket_' || {_SERIAL} || ' ' WHEN 5 THEN 'TICKET_' || l_linenumber
        WHEN 6 THEN 'XX-' || {_SERIAL} ELSE 'TICKET_A' || {_SERIAL} END END AS ticket_id""",
    "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE 'M' || l_orderkey END AS match_id",
    """CASE CAST(l_partkey % 9 AS INT) WHEN 0 THEN 'CATEGORY_1' WHEN 1 THEN 'category 2'
        WHEN 2 THEN 'CAT3' WHEN 3 THEN ' cat_1 ' WHEN 4 THEN '2' WHEN 5 THEN 'CATEGORY_3'
        WHEN 6 THEN 'VIP' WHEN 7 THEN NULL ELSE 'CATEGORY__1' END AS ticket_category""",
    """CASE WHEN l_partkey % 17 = 0 THEN NULL
        WHEN l_partkey % 19 = 0 THEN -CAST(l_quantity AS INT)
        ELSE CAST(l_quantity AS INT) * 8 END AS ticket_price_mad""",
    """CASE CAST(l_suppkey % 7 AS INT) WHEN 0 THEN 'WEBSITE' WHEN 1 THEN 'web'
        WHEN 2 THEN ' Online ' WHEN 3 THEN 'mobile_app' WHEN 4 THEN 'APP'
        WHEN 5 THEN NULL ELSE 'kiosk' END AS purchase_channel""",
    "'18:0' || l_linenumber AS entry_time",
    "'GATE_' || l_returnflag AS entry_gate",
    "CASE WHEN l_linestatus = 'F' THEN 'SCANNED' ELSE 'REJECTED' END AS scan_status",
)
ORDER = (
    f"CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE 'STD_' || {SITE} END AS stadium_id",
    """CASE CAST(l_suppkey % 6 AS INT) WHEN 0 THEN NULL
        WHEN 1 THEN 'FAN_' || (100000 + o_custkey)
        WHEN 2 THEN 'fan' || (100000 + o_custkey)
        WHEN 3 THEN ' fan_' || (100000 + o_custkey) || ' '
        WHEN 4 THEN CASE WHEN l_linenumber = 1 THEN 'F#' || o_custkey
                         ELSE 'FAN_' || (100000 + o_custkey) END
        ELSE 'FAN' || (100000 + o_custkey) END AS fan_id""",
    "CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS purchase_date",
    """CASE WHEN l_partkey % 4 = 0 THEN l_shipdate
        ELSE o_orderdate + INTERVAL '1' HOUR * l_linenumber END AS scan_timestamp""",
)


class Scenario:
    """Raw tables as lazy frames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def cities(self) -> DataFrame:
        located = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return located.selectExpr(
            "' ' || lower('C' || n_nationkey) || ' ' AS city_code",
            "' ' || n_name AS city_name",
            "' ' || r_name || ' ' AS region",
            "lower('AP' || n_nationkey) AS airport_code",
            "' dry ' AS climate_type",
        )

    def teams(self) -> DataFrame:
        located = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return located.selectExpr(
            "lower('T' || n_nationkey) || ' ' AS team_code",
            "' ' || n_name || ' ' AS team_name",
            "substr('abcde', n_regionkey + 1, 1) AS group",
            "lower(r_name) AS federation",
            "' Coach ' || n_nationkey AS coach_name",
        )

    def stadiums(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "'STD_' || s_suppkey AS stadium_id",
            "' ' || s_name AS stadium_name",
            "CASE WHEN s_suppkey % 11 = 4 THEN 'c99' ELSE lower('C' || s_nationkey) || ' ' END"
            " AS city_code",
            "' ' || s_suppkey || ' Main St ' AS full_address",
            "CAST(20000 + (s_suppkey % 7) * 5000 AS INT) AS seating_capacity",
            "CASE WHEN s_suppkey % 2 = 0 THEN 'natural ' ELSE ' Hybrid' END AS pitch_type",
            "'+212 5 ' || s_suppkey AS contact_phone",
            "' Info' || s_suppkey || '@X.ORG' AS email",
        )

    def matches(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "'M' || o_orderkey AS match_id",
            "CAST(o_orderdate AS DATE) AS match_date",
            "'1899-12-30T' || CASE WHEN o_orderkey % 2 = 0 THEN '17:00:00' ELSE '20:30:00' END"
            " || '.0000000' AS match_time",
            "' ' || o_orderpriority || ' ' AS stage",
            "substr('abcdef', CAST(o_orderkey % 6 AS INT) + 1, 1) AS group_code",
            f"CASE WHEN o_orderkey % 37 = 5 THEN ' nowhere' ELSE ' std_' || {SITE} END AS stadium_id",
            "'t' || (o_orderkey % 27) AS home_team_code",
            "'t' || ((o_orderkey + 7) % 25) || ' ' AS away_team_code",
            "' calm ' AS weather_notes",
        )

    def lines(self) -> DataFrame:
        """What of a scan comes from its line alone, for rules that need no more."""
        return self.table("lineitem").selectExpr(*LINE)

    def scans(self) -> DataFrame:
        lines = self.table("lineitem").join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        return lines.selectExpr(*LINE, *ORDER).select(*contracts.TICKET_SCANS.names)

    def scans_with_copies(self) -> DataFrame:
        """The scans, those of one stadium and channel twice."""
        twice = "CASE WHEN stadium_id = 'STD_3' AND purchase_channel = 'kiosk' THEN 2 ELSE 1 END"
        return (
            self.scans()
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.expr(twice))))
            .drop("__copy")
        )
