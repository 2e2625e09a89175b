"""Lookups give the same rows broadcast, salted and split over an oversize key."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom.operators.lookup import (
    AmbiguousLookup, duplicate_keys, fill_from_lookup, lookup_join, one_per_key,
)
from starloom.operators.skew import HotKeys, hot_keys


@pytest.fixture(scope="module")
def left(spark):
    return spark.range(900).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("own"), "id")).alias("own"),
    )


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame(
        [("hot", "h")] + [(f"k{i}", f"v{i}") for i in range(30)] + [("unused", "u")], "k string, v string"
    )


def test_large_lookups_agree_with_a_plain_join(left, right):
    expected = rows(left.join(right, "k", "left").select("id", "k", "own", "v"))
    on = {"k": F.col("k")}
    hot = hot_keys(left, ["k"], where=F.col("k").isNotNull(), group_rows=50, sample=1.0)
    assert hot.table().agg(F.max("__pieces")).first()[0] == 6
    for how in ({"small": True}, {"small": False, "hot": HotKeys()}, {"small": False, "hot": hot}, {}):
        assert rows(lookup_join(left, right, on, **how)) == expected


def test_only_rows_in_need_look_up(left, right):
    need = F.col("own").isNull()
    joined = left.join(right, "k", "left").select("id", F.when(need, F.col("v")).alias("v"))
    for small in (True, False):
        got = lookup_join(left, right, {"k": F.col("k")}, needed=need, small=small)
        assert rows(got, "id", "v") == rows(joined)


def test_fill_keeps_what_is_there(left, right):
    expected = left.join(right, "k", "left").select("id", "k", F.coalesce("own", "v").alias("own"))
    for small in (True, False):
        got = fill_from_lookup(left, right, {"k": F.col("k")}, "own", "v", small=small)
        assert got.columns == left.columns
        assert rows(got) == rows(expected)


def test_repeated_keys_do_not_multiply_rows(left, right, spark):
    more = right.union(spark.createDataFrame([("hot", "a"), (None, "n")], right.schema))
    got = fill_from_lookup(left, more, {"k": F.col("k")}, "own", "v")
    assert got.count() == left.count()
    assert rows(got.filter("k = 'hot' AND id % 2 = 1").select("own").distinct()) == [("a",)]
    assert rows(duplicate_keys(more, ["k"])) == [("hot", 2)]
    with pytest.raises(AmbiguousLookup):
        one_per_key(more, ["k"], ["v"], strict=True)
    assert one_per_key(right, ["k"], ["v"], strict=True).count() == right.count()


def test_large_fills_shuffle_only_rows_that_lack_something(left, right, spark):
    """Rows that have their value pass beside the join, and the lookup is dealt by its keys once."""
    got = fill_from_lookup(left, right, {"k": F.col("k")}, "own", "v", small=False, hot=HotKeys())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan and plan.count("Exchange hashpartitioning") == 2
        assert rows(got) == rows(left.join(right, "k", "left").select("id", "k", F.coalesce("own", "v").alias("own")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_smallest_lookup_row_counts_nulls_first(spark):
    data = [("a", "x", 2), ("a", "x", 1), ("a", None, 9), ("b", "y", None), ("b", "x", 3), (None, "z", 1), ("c", None, None)]
    frame = spark.createDataFrame(data, "k string, v string, n int")
    assert rows(one_per_key(frame, ["k"], ["v", "n"])) == [("a", None, 9), ("b", "x", 3), ("c", None, None)]


def test_a_named_key_is_not_carried_twice(spark):
    """A key given by its column's name joins as the same expression does, without a second copy of it."""
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "c")], "n int, k string")
    right = spark.createDataFrame([("a", 10), ("b", 20)], "k string, v int")
    for small in (True, False):
        named = lookup_join(left, right, {"k": "k"}, small=small)
        assert sorted(map(tuple, named.collect())) == [(1, "a", 10), (2, None, None), (3, "b", 20), (4, "c", None)]
        assert "__key_k" not in named._jdf.queryExecution().toString()
    wanted = lookup_join(left, right, {"k": "k"}, needed=F.col("n") > 1, small=False)
    assert sorted(map(tuple, wanted.collect()))[0] == (1, "a", None)
