"""Star and measures on small hand-made tables."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom import contracts, rules
from starloom.operators import profile, ranking
from starloom.operators.lookup import AmbiguousLookup
from starloom.plans import gold, measures
from starloom.registry import spark_queries
from starloom.rules import ScanPolicy

AT = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    scans = spark.createDataFrame(
        [
            ("TICKET_3", "FAN_B", True, "M1", "S1", "SCANNED", "2025-12-21 18:00:00"),
            ("TICKET_1", "FAN_A", True, "M1", "S1", "scanned", "2025-12-21 18:00:00"),
            ("TICKET_2", "N/A", True, None, "S1", "REJECTED", "2025-12-22 18:00:00"),
            ("TICKET_2", "FAN_A", True, "M9", None, "SCANNED", "2025-12-21 18:00:00"),
            ("TICKET_5", "FAN_Z", False, "M2", "S2", "SCANNED", None),
        ],
        "ticket_id string, fan_id string, is_fan_id_valid boolean, match_id string,"
        "stadium_id string, scan_status string, scan_timestamp string",
    ).withColumns(
        {
            "scan_timestamp": F.col("scan_timestamp").cast("timestamp"),
            "ticket_category": F.lit("CATEGORY_1"),
            "ticket_price_mad": F.lit(300),
            "purchase_channel": F.lit("WEBSITE"),
            "entry_gate": F.lit("G1"),
        }
    )
    matches = spark.createDataFrame(
        [("M1", "2025-12-21", "17:00:00", "Group", "A", "S1", "T1", "T2", "calm"),
         ("M2", "2025-12-25", "20:00:00", "Final", "B", "S7", "T1", "T9", "calm")],
        "match_id string, match_date string, match_time string, stage string, group_code string,"
        "stadium_id string, home_team_code string, away_team_code string, weather_notes string",
    ).withColumn("match_date", F.to_date("match_date")).withColumn(
        "match_datetime", F.to_timestamp(F.concat("match_date", F.lit(" "), "match_time"))
    )
    stadiums = spark.createDataFrame(
        [("S1", "One", "C1", "a", 100, "GRASS"), ("S2", "Two", "C2", "b", 0, "GRASS"),
         ("S3", "Three", "C1", "c", None, "GRASS")],
        "stadium_id string, stadium_name string, city_code string, full_address string,"
        "seating_capacity int, pitch_type string",
    )
    cities = spark.createDataFrame([("C1", "Rabat", "North"), ("C1", "Ramat", "South")],
                                   "city_code string, city_name string, region string")
    teams = spark.createDataFrame([("T1", "Lions", "A", "F", "x"), ("T2", "Eagles", "A", "F", "y")],
                                  "team_code string, team_name string, `group` string,"
                                  "federation string, coach_name string")
    return {"scans": scans, "matches": matches, "stadiums": stadiums, "cities": cities, "teams": teams}


@pytest.fixture(scope="module")
def star(tables):
    return gold.build_star(tables, F.lit(AT))


def test_contracts_hold(star):
    for name, table in star.items():
        contracts.assert_contract(table, contracts.GOLD[name])
        assert table.filter(F.col("load_ts") != F.lit(AT)).isEmpty()
    with pytest.raises(contracts.ContractError):
        contracts.assert_contract(star["dim_team"], contracts.DIM_FAN)


def test_stadium_takes_one_city(star):
    assert rows(star["dim_stadium"], "stadium_key", "city_name", "region") == [
        ("S1", "Rabat", "North"), ("S2", None, None), ("S3", "Rabat", "North")
    ]


def test_match_shows_the_stadiums_own_id(star):
    assert rows(star["dim_match"], "match_key", "stadium_id", "stadium_name", "home_team_name",
                "away_team_name") == [
        ("M1", "S1", "One", "Lions", "Eagles"), ("M2", None, None, "Lions", None)
    ]


def test_time_has_the_days_that_occur(star):
    assert rows(star["dim_time"], "date_key", "month_name", "day_type") == [
        (20251221, "December", "Weekend"), (20251222, "December", "Weekday"),
        (20251225, "December", "Weekday"),
    ]


def test_fans(star):
    assert rows(star["dim_fan"], "fan_key", "fan_id", "fan_category", "fan_type") == [
        (0, "N/A", "Unidentified", "Undentified"), (1, "FAN_A", "Regular", "Identified"),
        (2, "FAN_B", "Regular", "Identified"),
    ]


def test_fact_keys_and_unknown_members(star):
    got = rows(star["fact_ticket_scan"], "ticket_scan_key", "ticket_id", "match_key", "stadium_key",
               "fan_key", "date_key", "home_team_key", "away_team_key", "scan_day")
    assert got == [
        (1, "TICKET_1", "M1", "S1", 1, 20251221, "T1", "T2", "2025-12-21"),
        (2, "TICKET_2", "M9", "UNKNOWN", 1, 20251221, "UNKNOWN", "UNKNOWN", "2025-12-21"),
        (3, "TICKET_2", "UNKNOWN", "S1", 0, 20251222, "UNKNOWN", "UNKNOWN", "2025-12-22"),
        (4, "TICKET_3", "M1", "S1", 2, 20251221, "T1", "T2", "2025-12-21"),
        (5, "TICKET_5", "M2", "S2", 0, None, "T1", "T9", None),
    ]


def test_fact_is_stored_once_to_be_numbered(spark, tables, star, monkeypatch):
    """Distinct scans without a row id are sorted into one stored table, equal ones still get keys of their own."""
    made, store = [], ranking.materialize

    def watched(df, label="stage", **more):
        made.append(label)
        return store(df, label, **more)

    monkeypatch.setattr(ranking, "materialize", watched)
    twice = tables["scans"].unionByName(tables["scans"])
    fact = gold.fact_ticket_scan(twice, tables["matches"], star["dim_fan"])
    assert made == ["sorted"]
    once = [r[1] for r in rows(star["fact_ticket_scan"], "ticket_scan_key", "ticket_id")]
    assert rows(fact, "ticket_scan_key", "ticket_id") == sorted(
        ((k + 1, once[k // 2]) for k in range(10)), key=lambda r: [(True, str(v)) for v in r]
    )


def test_checks_on_the_fact(star):
    fact = star["fact_ticket_scan"]
    assert rows(profile.key_uniqueness(fact, "ticket_scan_key")) == [(5, 5, 0, True)]
    assert rows(profile.key_uniqueness(fact, "date_key")) == [(5, 2, 1, False)]
    missing = profile.orphans(fact, {"match_key": (star["dim_match"], "match_key"),
                                     "fan_key": (star["dim_fan"], "fan_key")})
    assert rows(missing) == [("fan_key", 0, 0), ("match_key", 2, 2)]


def test_fill_rates(star):
    got = measures.fill_rates(star["fact_ticket_scan"], star, ["stadium_key"])
    assert rows(got) == [("S1", 2, 100, 0.02), ("S2", 1, 0, 0.0), ("UNKNOWN", 1, None, 0.0)]
    by = {"stage": ("dim_match", "stage"), "home": ("home_team", "team_name")}
    staged = measures.fill_rates(star["fact_ticket_scan"], star, (), by)
    assert rows(staged) == [(None, None, 1, 100, 0.01), ("Final", "Lions", 1, 0, 0.0),
                            ("Group", "Lions", 2, 100, 0.02)]
    everything = measures.fill_rates(star["fact_ticket_scan"], star)
    assert rows(everything) == [(4, 100, 0.04)]


def test_measures_without_rows(star):
    none = star["fact_ticket_scan"].filter("ticket_id = 'x'")
    assert rows(measures.tickets(none)) == [(0,)]
    assert measures.distinct_tickets(none, count_null=True).first()[0] == 0
    assert rows(measures.fill_gauge(none, star["dim_stadium"])) == [(0, 400.0, 0.0)]


def test_gauge(star, spark):
    fact, dim = star["fact_ticket_scan"], star["dim_stadium"]
    assert rows(measures.fill_gauge(fact, dim)) == [(4, 400.0, 0.01)]
    assert rows(measures.fill_gauge(fact, dim, matches=9), "gauge") == [(0.04,)]
    assert rows(measures.fill_gauge(fact, dim.limit(1).withColumn("seating_capacity", F.lit(1)), 1, 9),
                "gauge") == [(1.0,)]
    assert rows(measures.fill_gauge(fact, dim, by_stadium=True)) == [
        ("S1", 3, 400.0, 0.0075), ("S2", 1, 0.0, 0.0), ("UNKNOWN", 1, None, 0.0)
    ]
    nulls = fact.withColumn("ticket_id", F.nullif("ticket_id", F.lit("TICKET_1")))
    assert measures.distinct_tickets(nulls).first()[0] == 3
    assert measures.distinct_tickets(nulls, count_null=True).first()[0] == 4


def test_occurring_members(star):
    got = measures.occurring(star["dim_stadium"], star["fact_ticket_scan"], "stadium_key")
    assert rows(got, "stadium_key") == [("S1",), ("S2",)]


def test_policy_reaches_the_star(tables, star):
    with pytest.raises(AmbiguousLookup):
        gold.build_star(tables, policy=ScanPolicy(strict_lookups=True))
    known = gold.build_star(tables, F.lit(AT), ScanPolicy(unknown_members=True))
    for name, key in (("dim_stadium", "stadium_key"), ("dim_team", "team_key"), ("dim_match", "match_key")):
        contracts.assert_contract(known[name], contracts.GOLD[name])
        assert known[name].count() == star[name].count() + 1
        assert known[name].filter(F.col(key) == rules.UNKNOWN_MEMBER).count() == 1


def test_joins_of_the_stored_star_carry_days(spark, folder, monkeypatch):
    """Facts without a time of day are joined without one, and fall on the same days."""
    seen, real = {}, gold.link_teams

    def note(scans, *args, **how):
        seen.update(scans.dtypes)
        return real(scans, *args, **how)

    plain = spark_queries.unkeyed_fact(spark, folder, plain=spark_queries.COUNTED)
    monkeypatch.setattr(gold, "link_teams", note)
    fact = spark_queries.stored_star(spark, folder)["fact"]
    assert seen["scan_timestamp"] == "date"
    columns = ["match_key", "stadium_key", "date_key", "away_team_key", "scan_status"]
    assert rows(fact, *columns) == rows(plain, *columns)
