"""The silver plans on the scenario: stage counts, conservation, determinism."""

import re
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom.operators import profile
from starloom.plans import silver_dims
from starloom.plans import silver_scans as plan
from starloom.plans.scenario import Scenario
from starloom.rules import ScanPolicy
from starloom.session import materialize


@pytest.fixture(scope="module")
def scenario(spark, folder):
    return Scenario(spark, folder)


@pytest.fixture(scope="module")
def raw(scenario):
    return materialize(scenario.scans_with_copies())


@pytest.fixture(scope="module")
def classified(raw):
    return materialize(plan.classify_scans(raw))


def test_stage_counts(raw, classified):
    by_table = dict(rows(classified.groupBy("audit_table").count()))
    assert raw.count() == 6061
    assert profile.duplicate_rows(raw).count() == 61
    assert by_table == {
        "ticket_id_null": 601, "ticket_id_doublons": 831, "ticket_id_invalide": 30,
        "ticket_id_irreparable": 611, "fan_id_irreparable": 59, "fan_id_doublons": 1039,
        "accepted": 1974 + 855,
    }


def test_nothing_is_lost(raw, classified):
    assert classified.agg(F.sum("count")).first()[0] == raw.count()
    audit = plan.audit_of(classified)
    rejected = audit.filter("audit_table <> 'complets_doublons'").count()
    assert rejected + plan.accepted_of(classified).count() == raw.distinct().count()
    assert audit.filter("audit_reason IS NULL OR audit_date IS NULL").count() == 0


def test_both_plans_accept_the_same_rows(raw, classified):
    lean = plan.cleaned_columns(plan.accepted_scans(raw))
    assert rows(lean) == rows(plan.cleaned_columns(plan.accepted_of(classified)))


def test_skewed_plan_gives_the_same_outcomes(raw, classified):
    skew = plan.scan_skew(raw, group_rows=3, sample=1.0)
    assert skew.ticket and skew.fan_at_match
    again = plan.classify_scans(raw, skew)
    columns = classified.columns
    assert rows(again.select(*columns)) == rows(classified)


def test_dedup_after_repair(raw):
    policy = ScanPolicy(dedup_after_repair=True)
    lean = plan.accepted_scans(raw, policy)
    full = plan.classify_scans(raw, plan.scan_skew(raw, policy, group_rows=3, sample=1.0), policy)
    assert rows(plan.cleaned_columns(lean)) == rows(plan.cleaned_columns(plan.accepted_of(full)))
    assert lean.groupBy("ticket_id_fixed").count().filter("count > 1").isEmpty()
    assert full.count() == raw.distinct().count()


@pytest.mark.parametrize("partitions", [1, 64])
def test_same_rows_for_any_partitioning(spark, raw, classified, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        again = plan.classify_scans(raw.repartition(5, "entry_gate").orderBy(F.desc("fan_id")))
        assert rows(again, *classified.columns) == rows(classified)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_enrichment_fills_only_gaps(spark):
    scans = spark.createDataFrame(
        [
            ("gap", None, "S1", "2025-12-21 18:00:00"),
            ("own", "M9", "S1", "2025-12-21 18:00:00"),
            ("site", "M1", None, "2025-12-21 18:00:00"),
            ("both", None, None, "2025-12-21 18:00:00"),
            ("day", None, "S1", "2025-12-22 18:00:00"),
            ("when", None, "S1", None),
        ],
        "name string, match_id string, stadium_id string, scan_timestamp string",
    ).withColumn("scan_timestamp", F.col("scan_timestamp").cast("timestamp"))
    matches = spark.createDataFrame(
        [("M1", "S1", "2025-12-21"), ("M2", "S2", "2025-12-21")],
        "match_id string, stadium_id string, match_date string",
    )
    for small in (True, False):
        filled = plan.fill_match_ids(scans, matches, small=small)
        located = plan.fill_stadium_ids(filled, matches, small=small)
        got = {r.name: (r.match_id, r.stadium_id) for r in located.collect()}
        assert got == {
            "gap": ("M1", "S1"), "own": ("M9", "S1"), "site": ("M1", "S1"),
            "both": (None, None), "day": (None, "S1"), "when": (None, "S1"),
        }


def test_silver_with_large_lookups(raw, scenario):
    matches = silver_dims.clean_matches(scenario.matches())
    assert rows(plan.silver_scans(raw, matches, small=False)) == rows(plan.silver_scans(raw, matches))


def test_unreadable_match_time(spark):
    match = spark.createDataFrame(
        [("M1", "late", " s ", "a", "s1", "h", "w", "x")],
        "match_id string, match_time string, stage string, group_code string, stadium_id string,"
        "home_team_code string, away_team_code string, weather_notes string",
    ).withColumn("match_date", F.to_date(F.lit("2025-12-21")))
    midnight = silver_dims.clean_matches(match).first()
    assert (midnight.match_time, str(midnight.match_datetime)) == ("", "2025-12-21 00:00:00")
    assert silver_dims.clean_matches(match, False).first().match_datetime is None


def test_keys_may_be_compared_normalised(spark, raw, scenario):
    matches = materialize(silver_dims.clean_matches(scenario.matches()))
    spelt = raw.withColumn("stadium_id", F.concat(F.lit(" "), F.lower("stadium_id")))
    plain = plan.silver_scans(spelt, matches)
    normal = plan.silver_scans(spelt, matches, ScanPolicy(normalize_keys=True))
    assert plain.filter("match_id IS NULL").count() > normal.filter("match_id IS NULL").count()
    assert rows(normal) == rows(plan.silver_scans(raw, matches))


def test_fans_may_be_deduplicated_after_enrichment(raw, scenario):
    matches = materialize(silver_dims.clean_matches(scenario.matches()))
    usual = plan.silver_scans(raw, matches)
    later = plan.silver_scans(raw, matches, ScanPolicy(dedup_fans_after_enrichment=True))
    known = "fan_id <> 'N/A' AND match_id IS NOT NULL"
    assert later.filter(known).groupBy("match_id", "fan_id").count().filter("count > 1").isEmpty()
    assert later.count() < usual.count() and later.exceptAll(usual).isEmpty()
    assert later.filter(f"NOT ({known})").count() == usual.filter(f"NOT ({known})").count()


def test_accepted_scans_are_shuffled_twice(raw):
    """By ticket, where copies meet as well, and by fan and match; repaired ids stay out of both."""
    plan_text = plan.accepted_scans(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("Exchange hashpartitioning") == 2


def test_copies_of_scans_count_once(raw):
    twice = raw.unionByName(raw)
    assert rows(plan.cleaned_columns(plan.accepted_scans(twice))) == rows(plan.cleaned_columns(plan.accepted_scans(raw)))


def test_rows_are_placed_without_what_follows_from_them(raw, classified):
    """The last shuffle and the stored rows hold neither repaired ids nor rule columns."""
    placed = plan.place_scans(raw)
    kept = {*plan.SCAN, "count", "row_num", "audit_table", "__ticket", "__fan"}
    assert set(placed.columns) == kept
    last = placed._jdf.queryExecution().optimizedPlan().toString().split("Window [")[1]
    assert "ticket_id_fixed" not in last and "ticket_id_raw" not in last
    columns = classified.columns
    assert rows(plan.told_scans(placed).select(*columns)) == rows(classified)


def test_ids_as_typed_come_back(spark, raw):
    """NULL, the anonymous mark itself, ids that change and ids that do not."""
    typed = ["FAN_100001", " fan_100002 ", None, "N/A", " n/a ", "", "F#3"]
    tickets = ["TICKET_1234567", " ticket_2 ", None, "", "XX-4", "TICKET_5", "tk_6"]
    one = raw.limit(1).drop("fan_id", "ticket_id")
    ids = spark.createDataFrame([(f, t) for f in typed for t in tickets], "fan_id string, ticket_id string")
    made = materialize(one.crossJoin(ids).select(*plan.SCAN))
    told = plan.classify_scans(made)
    assert rows(told.select("fan_id_raw", "ticket_id_raw")) == rows(made.select("fan_id", "ticket_id"))


def odd_copies(spark):
    """Scans that differ in one column, NULLs among them, some of them twice or three times, some without a ticket."""
    at = [datetime(2025, 12, 21, 18, n % 3) for n in range(6)]
    first = ("TICKET_1234567", "M1", "S1", "FAN_100001", "VIP", 80, "WEB", at[0].date(), "18:00", "A", "SCANNED", at[0])
    made = [first]
    for n, value in enumerate((" ticket_1234567 ", None, None, "fan100001", None, None, None, None, None, None, None, at[1])):
        made += [(*first[:n], value, *first[n + 1:])] * (1 + n % 3)
    made += [(None, *row[1:]) for row in made]
    return materialize(spark.createDataFrame(made, plan.contracts.TICKET_SCANS))


def test_copies_are_counted_by_the_sort_of_their_ranking(spark):
    raw = odd_copies(spark)
    order = ["ticket_id", "scan_timestamp", *[c for c in plan.SCAN if c not in ("ticket_id", "scan_timestamp")]]
    counted = profile.sorted_copies(raw.repartition("ticket_id"), order)
    assert rows(counted, *plan.SCAN, "count") == rows(profile.row_copies(raw), *plan.SCAN, "count")
    with pytest.raises(ValueError):
        profile.sorted_copies(raw, order[:-1])


def test_copies_and_ranks_of_tickets_share_a_shuffle(raw):
    text = plan.place_scans(raw)._jdf.queryExecution().executedPlan().toString()
    dealt, = re.findall(r"Exchange hashpartitioning\((.*?), \d+\), REPARTITION_BY_COL", text)
    assert dealt.startswith("ticket_id#") and "," not in dealt
    assert text.count("Exchange hashpartitioning") == 3 and text.count(" Sort [") == 2


@pytest.mark.parametrize("limits", [None, {"group_rows": 3, "sample": 1.0}])
@pytest.mark.parametrize("policy", [None, ScanPolicy(dedup_after_repair=True)])
def test_rejected_rows_are_stored_before_fans_are_ranked(spark, raw, limits, policy):
    for scans in (raw, odd_copies(spark)):
        skew = limits and plan.scan_skew(scans, policy, **limits)
        whole = plan.place_scans(scans, skew, policy)
        stored = plan.place_scans(scans, skew, policy, store=True)
        assert rows(stored, *whole.columns) == rows(whole)
    if limits is None and policy is None:
        text = stored._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1 and "hashpartitioning(match_id" in text
