"""Ranks and keys agree with one global window, whatever the partitioning or the skew."""

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.ranking import _groups, dense_key, keep_first, rank_rows, total_order
from starloom.operators.skew import HotKeys, gather, hot_keys, hot_keys_of, is_small


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, NULL keys, ties, and equal rows."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("k"),
        (F.col("id") % 2).alias("g"),
        (F.col("id") * 37 % 50).cast("int").alias("t"),
        (F.col("id") % 11).cast("string").alias("v"),
    )


def expected_ranks(df, keys, order):
    window = Window.partitionBy(*keys).orderBy(*total_order(df, order, keys))
    return df.withColumn("n", F.row_number().over(window).cast("bigint"))


def test_hot_keys_are_found_and_bounded(skewed):
    found = hot_keys(skewed, ["k"], group_rows=500, sample=1.0)
    assert [r["__pieces"] for r in found.table().collect()] == [2]
    assert not hot_keys(skewed, ["k"])


def test_one_grouping_does_not_crowd_out_another(spark):
    """Twenty thousand oversize keys of one kind leave the one of another kind found."""
    data = spark.range(60_000).select((F.col("id") % 20_000).alias("a"), F.lit(1).alias("b"))
    many, one = hot_keys_of(data, [(["a"], None), (["b"], None)], group_rows=2, sample=1.0)
    assert (many.groups, one.groups) == (20_000, 1)
    assert many.table().count() == 20_000


def test_ranks_are_bigint(skewed):
    hot = hot_keys(skewed, ["k"], group_rows=300, sample=1.0)
    for how in (None, hot):
        assert dict(rank_rows(skewed, ["k"], ["t"], "n", hot=how).dtypes)["n"] == "bigint"


@pytest.mark.parametrize("keys", [["k"], ["k", "g"]])
def test_hot_groups_are_ranked_like_the_others(skewed, keys):
    hot = hot_keys(skewed, keys, group_rows=300, sample=1.0)
    assert hot
    expected = rows(expected_ranks(skewed, keys, ["t"]))
    assert rows(rank_rows(skewed, keys, ["t"], "n")) == expected
    assert rows(rank_rows(skewed, keys, ["t"], "n", hot=hot)) == expected


def test_rows_not_eligible_pass_without_a_rank(skewed):
    known = F.col("k").isNotNull()
    expected = rows(
        expected_ranks(skewed.filter(known), ["k"], ["t"]).unionByName(
            skewed.filter(~known).withColumn("n", F.lit(None).cast("bigint"))
        )
    )
    hot = hot_keys(skewed, ["k"], where=known, group_rows=300, sample=1.0)
    assert rows(rank_rows(skewed, ["k"], ["t"], "n", known)) == expected
    assert rows(rank_rows(skewed, ["k"], ["t"], "n", known, hot)) == expected


def test_every_hash_may_be_hot(spark, skewed):
    everything = hot_keys(skewed, ["k"], group_rows=0.5, sample=1.0)
    assert rows(rank_rows(skewed, ["k"], ["t"], "n", hot=everything)) == rows(
        expected_ranks(skewed, ["k"], ["t"])
    )
    assert not HotKeys()


def test_keep_first(skewed):
    expected = rows(expected_ranks(skewed, ["k"], ["t"]).filter("n = 1").drop("n"))
    assert rows(keep_first(skewed, ["k"], ["t"])) == expected


def test_keep_first_leaves_other_rows_alone(skewed):
    data = skewed.withColumn("u", F.monotonically_increasing_id().cast("string"))
    only = F.col("g") == 1
    ties = ["k", "g", "t", "v"]
    stored = keep_first(data, ["k"], ["t"], ties, only=only)
    in_one = keep_first(data, ["k"], ["t"], ties, only=only, row_id="u")
    assert rows(stored, *ties) == rows(in_one, *ties)
    assert in_one.filter(~only).count() == data.filter(~only).count()


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_dense_key_is_the_global_row_number(spark, skewed, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        window = Window.orderBy(*total_order(skewed, ["k", "t"]))
        expected = rows(skewed.withColumn("n", F.row_number().over(window)))
        shuffled = skewed.repartition(partitions, "v").orderBy("v", "t")
        assert rows(dense_key(shuffled, ["k", "t"], "n")) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_dense_key_of_equal_rows_and_of_none(spark):
    same = spark.range(1000).select(F.lit("x").alias("k"))
    assert rows(dense_key(same, ["k"], "n"), "n") == sorted(
        [(i,) for i in range(1, 1001)], key=lambda r: str(r[0])
    )
    assert dense_key(same.filter("k = 'y'"), ["k"], "n").count() == 0


def test_is_small_checks_rows_and_bytes(spark):
    assert is_small(spark.range(10))
    assert not is_small(spark.range(11), max_rows=10)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("v"))
    assert not is_small(wide, max_bytes=9_000)
    assert is_small(spark.range(0))


def test_gather_rebalances_by_key(skewed):
    got = gather(skewed, ["k"])
    assert rows(got) == rows(skewed)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_the_lead_of_a_ranking_takes_four_bytes(spark):
    """Rows are dealt and sorted by an int; keys that share it are still groups of their own."""
    rows = [(f"k{i % 5000}", i) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k string, n int")
    assert df.select(_groups([F.col("k")])[0].alias("h")).dtypes == [("h", "int")]
    kept = keep_first(df, ["k"], ["n"], hashed="h")
    assert dict(kept.dtypes)["h"] == "int"
    assert sorted((r.k, r.n) for r in kept.collect()) == sorted((f"k{i}", i) for i in range(5000))


def test_ids_are_led_by_their_number_and_others_by_a_hash(spark):
    """Neighbouring ids stay beside each other; the same groups whatever ids end in."""
    keys = ["TICKET_1234567", "TICKET_1234568", "x_99123456789", "7", "  9", "é", "A7 ", "", None, "-0", "0"]
    df = spark.createDataFrame([(k, n) for k in keys for n in (3, 1, 2)], "k string, n int")
    lead = {r.k: r.lead for r in df.select("k", _groups([F.col("k")])[0].alias("lead")).collect()}
    assert [lead[k] for k in keys[:4]] == [1234567, 1234568, 123456789, 7]
    assert all(v is not None for v in lead.values())
    for hashed in (None, "h"):
        assert rows(keep_first(df, ["k"], ["n"], hashed=hashed), "k", "n") == rows(df.filter("n = 1"), "k", "n")
    pairs = spark.createDataFrame([("M12", "F3"), ("M12", "F4"), (None, "F5"), ("M", None)], "m string, f string")
    got = {(r.m, r.f): r.lead for r in pairs.select("*", _groups([F.col("m"), F.col("f")])[0].alias("lead")).collect()}
    assert (got["M12", "F3"], got["M12", "F4"], got[None, "F5"]) == (12, 12, 5)
    zeros = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 1), (float("nan"), 2)], "k double, n int")
    assert [r.n for r in keep_first(zeros, ["k"], ["n"]).collect()] == [1, 1]
    ranked = rank_rows(df, ["k"], ["n"], eligible=F.col("k").isNotNull())
    assert {(r.n, r.row_num) for r in ranked.collect() if r.k is not None} == {(1, 1), (2, 2), (3, 3)}
