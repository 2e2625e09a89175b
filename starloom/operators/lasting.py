"""Surrogate keys that last: a stored map from members to keys that later runs only add to."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.ranking import dense_key, rank_rows
from starloom.session import materialize, path_exists

RUN = "run_id"
_COPY = "__copy"


@dataclass(frozen=True)
class LastingKeys:
    """Folder of a star's key maps, and the run that adds to them.

    A run that is repeated finds its members in the map and adds nothing, so every key
    it gave before stays. Runs that add to one map must not overlap in time.
    """

    folder: str
    run: str

    def __post_init__(self):
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", self.run):
            raise ValueError(f"{self.run!r} cannot name a run")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"


def unseen(members: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct members that ``known`` lacks; NULL is a member like any other."""
    side = known.select(*[F.col(f"`{k}`").alias(f"__known_{k}") for k in keys])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"__known_{k}")) for k in keys]
    return members.select(*keys).distinct().join(side, same, "left_anti")


def assign_keys(members: DataFrame, known: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Keys for the members that ``known`` (``keys`` and ``name``) lacks: after its largest, in order.

    The same members against the same map always get the same keys. Numbering is that of
    ``dense_key``, without a global window; the driver learns the largest key only.
    """
    # Numbering samples its input for ranges, so what the anti join found is stored first.
    new = materialize(unseen(members, known, keys), "unseen")
    last = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    return dense_key(new, keys, name, unique=True).withColumn(name, F.col(name) + F.lit(last))


def extend_keys(
    spark: SparkSession, members: DataFrame, path: str, keys: Sequence[str], name: str, run: str
) -> DataFrame:
    """The map at ``path`` after adding what it lacks, as stored: ``keys``, ``name``, ``run_id``.

    Keys given before are never written again, changed or reused, also if their members are
    gone from ``members``.
    """
    fields = [members.schema[k] for k in keys] + [T.StructField(name, T.LongType())]
    schema = T.StructType([*fields, T.StructField(RUN, T.StringType())])

    def stored() -> DataFrame:
        if not path_exists(spark, path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(path)

    new = assign_keys(members, stored(), keys, name)
    new.withColumn(RUN, F.lit(run)).write.mode("append").partitionBy(RUN).parquet(path)
    return stored().select(*schema.names)


def with_lasting_key(
    spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], name: str, run: str
) -> DataFrame:
    """``df`` with a lasting key for every row, known by ``keys``.

    Rows that share them are told apart by their number in the order of all other columns: the
    group keeps its set of keys. ``df`` is stored once, as it is numbered and joined.
    """
    ranked = materialize(rank_rows(df, keys, [], name=_COPY), "keyed")
    natural = [*keys, _COPY]
    held = extend_keys(spark, ranked, path, natural, name, run)
    side = held.select(*[F.col(f"`{k}`").alias(f"__held_{k}") for k in natural], name)
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"__held_{k}")) for k in natural]
    return ranked.join(side, same, "left").select(*df.columns, name)
