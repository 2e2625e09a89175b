"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node that has an edge; the label is the component's least node.

    ``edges``: ``a`` and ``b``, longs, either direction, repeats and loops allowed.

    Each round ties larger neighbours to the least one (large star), then smaller ones
    (small star), until every edge leads from a node to its component's least node. A round
    is two aggregations by node, counted map-side, and two joins back, whose hot nodes
    adaptive execution splits. Every round is stored, so lineage stays short.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    now = edges.select(a.alias("a"), b.alias("b")).filter("a <> b").distinct()
    now = materialize(now, "edges")
    before = None
    while True:
        seen = now.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        ).first()
        if before == seen:
            # A round changed nothing: every node but the least has one edge, to the least.
            ends = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(ends)
        before = seen
        now = materialize(_round(now), "edges")


def _round(edges: DataFrame) -> DataFrame:
    """One large and one small star; ``a > b`` in every edge, before and after."""
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.unionByName(back)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (
        both.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    tied = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
