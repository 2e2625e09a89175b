"""Keys that last, matches by time, appends that can be repeated, several groupings at once."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom.operators.asof import asof_join
from starloom.operators.lasting import LastingKeys, extend_keys, with_lasting_key
from starloom.operators.skew import hot_keys
from starloom.plans import gold, measures, silver_scans
from starloom.plans import run as full_run
from starloom.plans.scenario import Scenario
from starloom.session import scratch_path
from starloom.sources import readers, writers


# ---- lasting keys -----------------------------------------------------------------
def test_keys_last_while_members_come_and_go(spark):
    path = scratch_path(spark, "map")
    runs = [["b", "d"], ["a", "b", None], ["c"], ["a", "b", "c", "d", None]]
    seen = {}
    for number, members in enumerate(runs):
        frame = spark.createDataFrame([(m,) for m in members * 3], "id string")
        held = extend_keys(spark, frame, path, ["id"], "key", f"r{number}").collect()
        now = {r.id: r.key for r in held}
        assert len(held) == len(now) and seen.items() <= now.items()
        seen = now
    assert seen == {"b": 1, "d": 2, None: 3, "a": 4, "c": 5}
    again = extend_keys(spark, frame, path, ["id"], "key", "r0").collect()
    assert {r.id: r.key for r in again} == seen and {r.run_id for r in again} == {"r0", "r1", "r2"}


def test_keys_of_empty_tables(spark):
    path = scratch_path(spark, "map")
    none = spark.createDataFrame([], "id string")
    assert extend_keys(spark, none, path, ["id"], "key", "r").count() == 0
    assert [r.key for r in extend_keys(spark, none.union(spark.sql("SELECT 'x'")), path, ["id"], "key", "s").collect()] == [1]


def test_rows_that_share_a_natural_key_keep_their_set_of_keys(spark):
    path = scratch_path(spark, "map")
    first = spark.createDataFrame([("t", 1, "b"), ("t", 1, "b"), ("u", 2, "a")], "id string, at int, x string")
    one = with_lasting_key(spark, first, path, ["id", "at"], "key", "1")
    assert rows(one) == [("t", 1, "b", 1), ("t", 1, "b", 2), ("u", 2, "a", 3)]
    second = first.unionByName(spark.createDataFrame([("t", 1, "c"), ("a", None, "z")], first.schema))
    two = with_lasting_key(spark, second, path, ["id", "at"], "key", "2")
    assert rows(two) == sorted([("t", 1, "b", 1), ("t", 1, "b", 2), ("t", 1, "c", 5), ("u", 2, "a", 3), ("a", None, "z", 4)], key=str)


def test_a_run_needs_a_name_that_is_a_folder():
    with pytest.raises(ValueError, match="name a run"):
        LastingKeys("f", "a/b")


def test_star_keeps_keys_over_growing_runs(spark, folder, tmp_path):
    source = Scenario(spark, folder)
    raw = {n: getattr(source, n)() for n in ("matches", "stadiums", "teams", "cities")}
    layout = full_run.Layout(str(tmp_path))
    early = source.scans().filter("scan_timestamp < '1995-06-01'")
    keys = []
    for name, scans in (("one", early), ("two", source.scans()), ("two", source.scans())):
        full_run.run_all(spark, raw | {"scans": scans}, layout, run=name)
        star = full_run.read_star(spark, layout)
        fans = {r.fan_id: r.fan_key for r in star["dim_fan"].collect()}
        fact = star["fact_ticket_scan"].join(star["dim_fan"], "fan_key")
        found = fact.select("ticket_id", "scan_timestamp", "fan_id", "ticket_scan_key").collect()
        assert len({r.ticket_scan_key for r in found}) == len(found)
        audits = readers.read_table(spark, layout.path("audit", "rejected_scans"), text_columns=["run_id"])
        keys.append((fans, {r.ticket_scan_key: r.ticket_id for r in found}, rows(audits.groupBy("run_id").count())))
    assert keys[0][0].items() < keys[1][0].items() and keys[0][1].items() < keys[1][1].items()
    assert keys[1] == keys[2] and set(keys[0][2]) < set(keys[1][2])


# ---- as-of join -------------------------------------------------------------------
T0 = datetime(2025, 12, 1, 12)


def at(minutes):
    return None if minutes is None else T0 + timedelta(minutes=minutes)


def nearest_by_hand(left, right, direction):
    out = []
    for key, time, name in left:
        same = [(t, v) for k, t, v in right if k == key and None not in (k, t, time)]
        back = max(((t, v) for t, v in same if t <= time), key=lambda x: (x[0], [-ord(c) for c in x[1]]), default=None)
        ahead = min(((t, v) for t, v in same if t >= time), default=None)
        if direction == "nearest":
            pick = min([p for p in (back, ahead) if p], key=lambda p: (abs(p[0] - time), p[0]), default=None)
        else:
            pick = back if direction == "backward" else ahead
        out.append((key, at(time), name, pick[1] if pick else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("direction", ["nearest", "backward", "forward"])
def test_asof_by_hand(spark, direction, split):
    left = [(k, t, f"l{t}") for k in ("a", "b", "none", None) for t in (None, 0, 5, 10, 15, 20, 20, 99)] * 2
    left += [("hot", t % 50, "h") for t in range(300)]
    right = [("a", 5, "y"), ("a", 5, "x"), ("a", 15, "z"), ("b", 50, "q"), (None, 5, "n"), ("a", None, "n"), ("hot", 7, "p"), ("hot", 31, "r")]
    schema = "k string, at timestamp, name string"
    frame = spark.createDataFrame([(k, at(t), n) for k, t, n in left], schema)
    side = spark.createDataFrame([(k, at(t), n) for k, t, n in right], "k string, at timestamp, value string")
    hot = hot_keys(frame, ["k"], group_rows=20, sample=1.0) if split else None
    got = asof_join(frame, side, {"k": F.col("k")}, F.col("at"), "at", ["value"], direction, hot=hot)
    assert got.columns == ["k", "at", "name", "value"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == nearest_by_hand(left, right, direction)
    empty = asof_join(frame, side.limit(0), {"k": F.col("k")}, F.col("at"), "at", ["value"], direction)
    assert empty.filter("value IS NULL").count() == len(left)
    if direction == "nearest":
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_asof_needs_a_known_direction(spark):
    with pytest.raises(ValueError, match="direction"):
        asof_join(spark.range(1), spark.range(1), {}, F.col("id"), "id", [], "sideways")


def test_the_policy_takes_the_nearest_match(spark):
    matches = spark.createDataFrame(
        [("m1", "s", "2025-12-01", "2025-12-01 13:00:00"), ("m2", "s", "2025-12-01", "2025-12-01 20:00:00")],
        "match_id string, stadium_id string, match_date string, match_datetime string",
    ).select("match_id", "stadium_id", F.to_date("match_date").alias("match_date"), F.to_timestamp("match_datetime").alias("match_datetime"))
    scans = spark.createDataFrame([(None, "s", at(60 * 7)), (None, "s", at(0)), ("m9", "s", at(0)), (None, None, at(0))], "match_id string, stadium_id string, scan_timestamp timestamp")
    got = silver_scans.fill_nearest_match_ids(scans, matches)
    assert rows(got, "match_id") == [(None,), ("m1",), ("m2",), ("m9",)]


# ---- appends ----------------------------------------------------------------------
def test_a_repeated_run_replaces_only_its_own(spark):
    path = scratch_path(spark, "runs")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "x int, day string")
    assert writers.append_run(frame, path, "2025-01", partition_by=["day"]) == 2
    assert writers.append_run(frame, path, "other", partition_by=["day"]) == 2
    writers.append_run(frame.filter("x = 1"), path, "2025-01", partition_by=["day"])

    def stored():
        return rows(readers.read_table(spark, path, text_columns=["run_id"]), "x", "day", "run_id")

    assert stored() == [(1, "a", "2025-01"), (1, "a", "other"), (2, "b", "other")]
    writers.append_run(frame.limit(0), path, "2025-01", partition_by=["day"])
    assert stored() == [(1, "a", "other"), (2, "b", "other")]
    with pytest.raises(ValueError, match="name a run"):
        writers.append_run(frame, path, "../x")


# ---- slices -----------------------------------------------------------------------
def test_slices_equal_single_groupings(spark):
    fact = spark.createDataFrame(
        [("s1", "web", "SCANNED"), ("s1", None, "SCANNED"), ("s2", "web", "no"), ("s3", "app", "scanned"), (None, "web", "SCANNED")],
        "stadium_key string, purchase_channel string, scan_status string",
    )
    star = {"dim_stadium": spark.createDataFrame([("s1", 10), ("s2", 40)], "stadium_key string, seating_capacity int")}
    many = measures.fill_rate_slices(fact, star, [["stadium_key"], ["purchase_channel"], []])
    columns = ["tickets", "capacity", "fill_rate"]
    for number, by in ((1, ["stadium_key"]), (2, ["purchase_channel"]), (3, [])):
        alone = measures.fill_rates(fact, star, by)
        assert rows(many.filter(F.col("slice") == number), *by, *columns) == rows(alone, *by, *columns)
    assert gold.ROW_ID not in many.columns
    # One aggregation of the fact before the dimension; the groupings expand what it leaves.
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("count_if" if "count_if" in plan else "Aggregate")
