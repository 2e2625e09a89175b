"""States that add up, contents compared, files merged and landed once, samples per group."""

import hashlib
import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import distinct, profile
from starloom.plans import gold
from starloom.sources import ledger, writers


# ---- distinct states ---------------------------------------------------------------
def test_states_add_up_to_distinct_counts(spark, tmp_path):
    r = random.Random(4)
    data = [(f"d{r.randrange(6)}", f"s{r.randrange(4)}", r.choice([None, *[f"f{i}" for i in range(300)]])) for _ in range(3000)]
    data += [("d9", "s9", None), (None, "s0", "f1"), (None, None, None)]
    visits = spark.createDataFrame(data, "day string, site string, fan string")
    numbers = distinct.number_members(visits, "fan", ["day", "site"])
    keys = {x.fan: x.member_no for x in numbers.collect()}
    assert sorted(keys.values()) == list(range(1, len({f for *_, f in data if f}) + 1))
    # Days are stored by two runs, and a day has parts in both.
    path = str(tmp_path / "state")
    for part in (visits.filter("fan < 'f2' OR fan IS NULL"), visits.filter("fan >= 'f2'")):
        state = distinct.distinct_state(part.join(numbers, "fan", "left"), "member_no", ["day", "site"])
        writers.append(state, path)
    stored = spark.read.parquet(path)
    for by in (["day", "site"], ["site"], ["day"], []):
        at = [["day", "site"].index(c) for c in by]
        want = {}
        for row in data:
            want.setdefault(tuple(row[i] for i in at), set()).add(row[2])
        got = {tuple(x[: len(by)]): x[len(by)] for x in distinct.count_states(stored, by).collect()}
        assert got == {k: len(v - {None}) for k, v in want.items()}


def test_states_beyond_one_bucket(spark):
    visits = spark.range(100000).select((F.col("id") % 3).alias("site"), F.col("id").cast("string").alias("fan"))
    numbers = distinct.number_members(visits, "fan", ["site"])
    state = distinct.distinct_state(visits.join(numbers, "fan"), "member_no", ["site"])
    # Members of a site have numbers next to each other: at most two buckets a site, not four.
    assert max(x["count"] for x in state.groupBy("site").count().collect()) <= 3
    assert rows(distinct.count_states(state, ["site"])) == [(0, 33334), (1, 33333), (2, 33333)]
    assert rows(distinct.count_states(state, [])) == [(100000,)]
    empty = distinct.count_states(state.limit(0), ["site"])
    assert empty.count() == 0


def test_states_of_small_groups_are_small(spark):
    """A group of two members costs a word or two, not a bitmap of its whole bucket."""
    visits = spark.range(5000).select(F.col("id").cast("string").alias("fan"), (F.col("id") % 2500).alias("site"))
    numbers = distinct.number_members(visits, "fan", ["site"])
    state = distinct.distinct_state(visits.join(numbers, "fan"), "member_no", ["site"])
    merged = distinct.merge_states(state.unionByName(state), ["site"])
    for held in (state, merged):
        assert held.agg(F.max(F.octet_length(F.to_json("bits")))).first()[0] < 200
        assert {x.n_distinct for x in distinct.count_states(held, ["site"]).collect()} == {2}
        assert rows(distinct.count_states(held, [])) == [(5000,)]


# ---- contents ----------------------------------------------------------------------
def test_content_notices_one_cell(spark, tmp_path):
    data = [(i, None if i % 7 == 0 else f"v{i % 5}", i % 3, 0.5 * i) for i in range(200)]
    frame = spark.createDataFrame(data, "id long, name string, part int, price double")
    path = str(tmp_path / "table")
    written = writers.write_checked(frame, path, partition_by=["part"])
    stored = spark.read.schema("id long, name string, price double, part int").parquet(path)
    assert writers.reconcile_content(stored, written).count() == 200
    assert writers.content(frame.repartition(5).select(*reversed(frame.columns))) == written
    other = stored.withColumn("price", F.when(F.col("id") == 77, 1.0).otherwise(F.col("price")))
    with pytest.raises(writers.ContentMismatch):
        writers.reconcile_content(other, written)
    with pytest.raises(writers.CountMismatch, match="199 rows"):
        writers.reconcile_content(stored.filter("id <> 3"), written)
    # A row twice in place of another one, and a NULL that moves to the next column.
    twice = stored.filter("id <> 3").unionByName(stored.filter("id = 4"))
    assert writers.content(twice) != written
    pair = spark.createDataFrame([("a", None)], "x string, y string")
    assert writers.content(pair) != writers.content(pair.select(F.col("y").alias("x"), F.col("x").alias("y")))
    assert writers.content(frame.limit(0)).rows == 0


# ---- files -------------------------------------------------------------------------
def test_merged_files_follow_from_bytes(spark, tmp_path):
    frame = spark.range(200000).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    small, merged = str(tmp_path / "small"), str(tmp_path / "merged")
    frame.repartition(40).write.parquet(small)
    sizes = [f.stat().st_size for f in Path(small).glob("*.parquet")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert len(sizes) == 40
    target = sum(sizes) // 4
    assert writers.merge_files(spark, small, merged, target) == 200000
    assert 4 <= len(list(Path(merged).glob("*.parquet"))) <= 6
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert writers.content(spark.read.parquet(merged)) == writers.content(frame)
    one = str(tmp_path / "one")
    writers.merge_files(spark, small, one, 10 * sum(sizes))
    assert len(list(Path(one).glob("*.parquet"))) == 1


def test_only_new_files_are_landed(spark, tmp_path):
    schema = T.StructType.fromDDL("id long, name string")
    landing, target, taken = tmp_path / "in put", str(tmp_path / "rows"), str(tmp_path / "ledger")
    landing.mkdir()

    def land(run):
        return ledger.land_new(spark, str(landing), target, taken, run, schema, options={"header": "true"})

    def read():
        return rows(ledger.read_landed(spark, target, taken, schema), "id", "name", "run_id")

    (landing / "a.csv").write_text("id,name\n1,x\n2,y\n")
    assert land("r1") == 2
    assert land("r1") == 2  # repeated: the same files, once
    assert land("r2") == 0  # nothing new
    (landing / "b 1.csv").write_text("id,name\n3,z\n")
    assert land("r3") == 1
    assert read() == [(1, "x", "r1"), (2, "y", "r1"), (3, "z", "r3")]
    (landing / "a.csv").write_text("id,name\n1,x\n2,other\n4,w\n")  # changed: landed again, in place of the old rows
    assert land("r4") == 3
    assert read() == [(1, "x", "r4"), (2, "other", "r4"), (3, "z", "r3"), (4, "w", "r4")]
    files = ledger.ledger_of(spark, taken)
    assert files.filter("run_id = 'r4'").count() == 1
    assert files.count() == 3


def test_a_run_that_lost_its_ledger_is_repeated(spark, tmp_path, monkeypatch):
    schema = T.StructType.fromDDL("id long")
    landing, target, taken = tmp_path / "in", str(tmp_path / "rows"), str(tmp_path / "ledger")
    landing.mkdir()
    (landing / "a.csv").write_text("1\n2\n")
    add, calls = ledger.append_run, []

    def once(df, path, run):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return add(df, path, run)

    monkeypatch.setattr(ledger, "append_run", once)
    with pytest.raises(RuntimeError, match="lost"):
        ledger.land_new(spark, str(landing), target, taken, "r1", schema)
    assert ledger.land_new(spark, str(landing), target, taken, "r1", schema) == 2
    assert rows(ledger.read_landed(spark, target, taken, schema), "id") == [(1,), (2,)]


# ---- samples -----------------------------------------------------------------------
def test_samples_per_group(spark):
    r = random.Random(8)
    data = [(r.choice([None, "a", "a", "a", "b"]), r.choice([None, "x", f"y{i}"]), r.randrange(4)) for i in range(500)]
    data += [("only", "z", 1)]
    frame = spark.createDataFrame(data, "g string, k string, n int")
    sampled = profile.sample_per_group(frame, ["g"], 4, ["k"], seed="t")

    def place(row):
        mark = hashlib.md5("|".join(["t", *([row[1]] if row[1] is not None else [])]).encode()).hexdigest()
        return mark, row[1] is not None, row[1] or "", row[2]

    want = []
    for g in {x[0] for x in data}:
        want += sorted((x for x in data if x[0] == g), key=place)[:4]
    assert sorted(map(str, rows(sampled))) == sorted(map(str, want))
    plan = sampled._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan[plan.index("Exchange") :]  # cut before the shuffle
    assert profile.sample_per_group(frame.limit(0), ["g"], 4, ["k"]).count() == 0


def test_match_names_need_no_look_at_windows(spark, monkeypatch):
    """Whether lookups are small is seen from the tables given, once for both teams."""
    looked = []
    monkeypatch.setattr(gold, "is_small", lambda df: looked.append(df.columns) or True)
    matches = spark.createDataFrame(
        [("m1", "s1", "t1", "t9")],
        "match_id string, stadium_id string, home_team_code string, away_team_code string",
    )
    for c in ("match_date", "match_time", "match_datetime", "stage", "group_code", "weather_notes"):
        matches = matches.withColumn(c, F.lit(c))
    venues = spark.createDataFrame([("s1", "S"), ("s1", "A")], "stadium_id string, stadium_name string")
    teams = spark.createDataFrame([("t1", "T")], "team_code string, team_name string")
    got = gold.dim_match(matches, venues, teams)
    assert rows(got, "match_key", "stadium_name", "home_team_name", "away_team_name") == [("m1", "A", "T", None)]
    assert looked == [["stadium_id", "stadium_name"], ["team_code", "team_name"]]
