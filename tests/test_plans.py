"""The physical plans are the ones meant: shuffles, limits, pushdown, no Python."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, queries
from starloom import contracts
from starloom.operators import ranking
from starloom.operators.lookup import lookup_join
from starloom.operators.ranking import dense_key
from starloom.operators.skew import HotKeys
from starloom.plans import gold
from starloom.plans import silver_scans as plan
from starloom.plans.scenario import Scenario
from starloom.session import materialize


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, folder):
    return materialize(Scenario(spark, folder).scans_with_copies())


def test_accepted_rows_take_three_shuffles(raw):
    text = physical(plan.cleaned_columns(plan.accepted_scans(raw)))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3
    assert "SinglePartition" not in text and "Union" not in text
    assert len(re.findall(r"WindowGroupLimit .*Partial", text)) == 2


def test_one_pass_takes_three_shuffles(raw):
    text = physical(plan.classify_scans(raw))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3
    assert "SinglePartition" not in text


def test_copies_are_counted_before_the_shuffle(raw):
    text = physical(plan.profile.row_copies(raw))
    assert "partial_count" in text and text.count("Exchange") == 1


def test_null_filter_and_columns_reach_the_scan(raw):
    text = physical(plan.with_ticket_id(raw.filter("ticket_id IS NOT NULL").select("ticket_id")))
    assert "PushedFilters: [IsNotNull(ticket_id)]" in text
    assert "ReadSchema: struct<ticket_id:string>" in text


def test_dense_key_has_no_window_and_no_single_task(raw):
    text = physical(dense_key(raw.select("ticket_id", "fan_id"), ["ticket_id"], "n"))
    assert "Window" not in text and "SinglePartition" not in text
    assert "BroadcastHashJoin" in text


def test_large_lookup_is_hashed_and_small_one_broadcast(spark, raw):
    side = raw.select("match_id", F.col("fan_id").alias("f")).dropDuplicates(["match_id"])
    on = {"match_id": F.col("match_id")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = spark.sql("SELECT bigint(1) AS __key_hash, 2 AS __pieces")
        salted = physical(lookup_join(raw, side, on, small=False, hot=HotKeys(one, 1)))
        assert "SortMergeJoin" in salted and "__salt" in salted
        assert "BroadcastHashJoin" in physical(lookup_join(raw, side, on))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))


@pytest.mark.parametrize("name", ["silver_scans", "tickets_by_stadium", "dim_match", "classified_scans"])
def test_no_python_and_no_cross_join(spark, folder, name):
    text = physical(queries()[name](spark, folder))
    assert not re.search(r"Python|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["stadium_key", "stadium_name", "tickets", "capacity", "fill_rate"]
    assert df.count() == 11


def test_cleaned_scans_are_stored_with_what_is_read(spark):
    at = datetime(1997, 5, 1, 18)
    rows = [
        (f"TICKET_{1000000 + i % 4}", "M1", "STD_1" if i % 3 else None, f"FAN_10000{i}", "VIP", 80, "WEBSITE", at.date(), "18:00", "A", "SCANNED", at)
        for i in range(8)
    ]
    names = "ticket_id match_id stadium_id fan_id ticket_category ticket_price_mad purchase_channel purchase_date entry_time entry_gate scan_status scan_timestamp"
    scans = spark.createDataFrame([dict(zip(names.split(), r, strict=True)) for r in rows], contracts.TICKET_SCANS)
    whole = plan.cleaned_columns(plan.accepted_scans(scans))
    kept = plan.kept_scans(scans, False, columns=("ticket_id", "scan_status"))
    read = ["match_id", "stadium_id", "scan_status", "scan_timestamp", "ticket_id_fixed"]
    assert kept.columns == read and kept.count() == 4
    assert sorted(map(str, kept.collect())) == sorted(map(str, whole.select(*read).collect()))


def test_days_are_not_sorted_along_with_the_fact(spark, monkeypatch):
    stored, real = {}, ranking.materialize

    def note(df, label="stage", **how):
        stored[label] = df.columns
        return real(df, label, **how)

    monkeypatch.setattr(ranking, "materialize", note)
    at = datetime(1997, 5, 1, 18)
    scans = spark.createDataFrame(
        [("M1", "STD_1", f"TICKET_{n}", "VIP", 80, "WEB", "SCANNED", at, "A", "FAN_100001", True) for n in (2, 1)],
        "match_id string, stadium_id string, ticket_id string, ticket_category string, ticket_price_mad int, purchase_channel string, "
        "scan_status string, scan_timestamp timestamp, entry_gate string, fan_id string, is_fan_id_valid boolean",
    )
    matches = spark.createDataFrame([("M1", "T1", "T2")], "match_id string, home_team_code string, away_team_code string")
    fans = spark.createDataFrame([("FAN_100001", 1)], "fan_id string, fan_key long")
    fact = gold.fact_ticket_scan(scans, matches, fans, skew_of=scans)
    assert not {"scan_day", "date_key"} & set(stored["sorted"])
    got = sorted((r.ticket_scan_key, r.ticket_id, r.date_key, r.scan_day, r.fan_key, r.away_team_key) for r in fact.collect())
    assert got == [(n, f"TICKET_{n}", 19970501, "1997-05-01", 1, "T2") for n in (1, 2)]


@pytest.mark.parametrize("name", ["classified_scans", "observed_metrics", "audit_rows"])
def test_rejected_rows_are_stored_before_the_last_shuffle(spark, folder, monkeypatch, name):
    stored, real = [], plan.materialize

    def note(df, label="stage", **how):
        stored.append(label)
        return real(df, label, **how)

    monkeypatch.setattr(plan, "materialize", note)
    queries()[name](spark, folder)
    assert stored == ["judged"]
