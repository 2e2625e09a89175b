"""Distinct counts that add up: exact states per group, merged to any coarser group.

A member is numbered once, then a state is a list of 64-bit words for every 32,768 numbers of which a
group has one, without the words that are zero: a group of few members is as small as they are few. States of days
are stored, appended and united without the rows they came from, which a stored count does not allow, as a
member may be on several days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.ranking import dense_key

BUCKET, BITS = "bucket", "bits"
_WORD, _MASK = "__word", "__mask"
#: Numbers of a word and of a bucket, as powers of two.
_WORD_BITS, _BUCKET_BITS = 6, 15


def number_members(rows: DataFrame, member: str, near: Sequence[str] = (), name: str = "member_no") -> DataFrame:
    """``member, name``: every distinct member with a number 1..n.

    Members are numbered in the order of the smallest ``near`` that they occur with, so those of one
    group have numbers next to each other and a group's state has few words.
    """
    known = rows.filter(F.col(member).isNotNull())
    if not near:
        return dense_key(known.select(member).distinct(), [member], name, unique=True)
    first = F.min(F.struct(*[F.col(c) for c in near])).alias("__first")
    members = known.groupBy(member).agg(first).select(member, *[F.col(f"__first.{c}").alias(f"__{c}") for c in near])
    keyed = dense_key(members, [*[f"__{c}" for c in near], member], name, unique=True)
    return keyed.select(member, name)


def distinct_state(rows: DataFrame, number: str, by: Sequence[str]) -> DataFrame:
    """``by, bucket, bits``: the members of each group, one row for every bucket it has any in.

    Bits are set map-side, in one long per word, so no buffer is larger than the members it holds. Rows
    without a number are in no word but keep their group, with no bucket.
    """
    place = F.col(number) - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit((1 << _WORD_BITS) - 1)).cast("int"))
    words = rows.select(
        *by, F.shiftright(place, _BUCKET_BITS).alias(BUCKET), F.shiftright(place, _WORD_BITS).alias(_WORD), bit.alias(_MASK)
    )
    return _packed(_united(words, by), by)


def _united(words: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group and word; groups without any have one without a word."""
    return words.groupBy(*by, BUCKET, _WORD).agg(F.bit_or(_MASK).alias(_MASK))


def _packed(words: DataFrame, by: Sequence[str]) -> DataFrame:
    some = F.when(F.col(_WORD).isNotNull(), F.struct(F.col(_WORD).alias("word"), F.col(_MASK).alias("mask")))
    return words.groupBy(*by, BUCKET).agg(F.collect_list(some).alias(BITS))


def _unpacked(state: DataFrame, by: Sequence[str]) -> DataFrame:
    each = state.select(*by, BUCKET, F.explode_outer(BITS).alias("__each"))
    return each.select(*by, BUCKET, F.col("__each.word").alias(_WORD), F.col("__each.mask").alias(_MASK))


def merge_states(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """The states of coarser groups, or of parts stored at different times."""
    return _packed(_united(_unpacked(state, by), by), by)


def count_states(state: DataFrame, by: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """Distinct members per group of ``by``; groups without any count 0."""
    counted = _united(_unpacked(state, by), by).groupBy(*by).agg(F.sum(F.bit_count(_MASK)).alias(name))
    return counted.withColumn(name, F.coalesce(name, F.lit(0)))
