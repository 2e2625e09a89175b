"""Left lookups against a table with one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.skew import HASH, PIECES, SALT, HotKeys, hot_keys, is_small, key_hash


class AmbiguousLookup(ValueError):
    """Two rows of a strict lookup share a key."""


def one_per_key(
    lookup: DataFrame, keys: Sequence[str], values: Sequence[str], strict: bool = False
) -> DataFrame:
    """One row per non-NULL key: the smallest by ``values``.

    A lookup with one row per key cannot multiply the rows it is joined to. Copies meet map-side, and the
    rows come out dealt by their keys, so a join by these alone does not shuffle them again.
    """
    usable = lookup.select(*keys, *values).dropna(subset=list(keys))
    if strict:
        repeated = duplicate_keys(usable, keys).first()
        if repeated is not None:
            raise AmbiguousLookup(f"{dict(repeated.asDict())}")
    # Structs compare field by field with NULLs first, as ``total_order`` does.
    first = usable.groupBy(*keys).agg(F.min(F.struct(*values)).alias("__first"))
    return first.select(*keys, *[F.col(f"__first.{v}").alias(v) for v in values])


def duplicate_keys(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def _value(key: Column | str) -> Column:
    return F.col(f"`{key}`") if isinstance(key, str) else key


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, Column | str],
    needed: Column | None = None,
    small: bool | None = None,
    hot: HotKeys | None = None,
    matchable: bool = False,
) -> DataFrame:
    """``left`` with the non-key columns of ``lookup``, NULL where nothing matches.

    ``on`` maps each key column of the lookup to the expression on ``left`` it must equal, or to the name of
    a column, which is then not shuffled a second time as a key. ``lookup`` has one row per key. Rows for which ``needed`` is not true match nothing.

    A lookup proven small is broadcast and ``left`` is not shuffled. A larger one is
    joined by hash with a salt: rows that cannot match are spread by their own hash, and
    the rows of an oversize key are dealt over copies of that key's one lookup row.
    ``matchable``: no row of ``left`` has a NULL key or no need, so without oversize keys there is no salt.
    """
    keys = list(on)
    taken = [c for c in lookup.columns if c not in keys]
    renamed = {k: f"__on_{k}" for k in keys}
    side = lookup.withColumnsRenamed(renamed)
    wanted = F.lit(True) if needed is None else F.coalesce(needed, F.lit(False))

    # Key expressions are computed on the left before the join, where names are its own.
    plain = {k for k, e in on.items() if isinstance(e, str) and needed is None}
    probe = left.withColumns({f"__key_{k}": F.when(wanted, _value(e)) for k, e in on.items() if k not in plain})
    probe_keys = [_value(on[k]) if k in plain else F.col(f"__key_{k}") for k in keys]
    match = [e == F.col(renamed[k]) for k, e in zip(keys, probe_keys, strict=True)]

    if small is None:
        small = is_small(lookup)
    if small:
        joined = probe.join(F.broadcast(side), match, "left")
    else:
        found = F.lit(True)
        for k in probe_keys:
            found = found & k.isNotNull()
        if hot is None:
            hot = hot_keys(probe, probe_keys, where=found)
        own_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
        if hot:
            table = hot.table()
            probe = probe.withColumn(HASH, key_hash(probe_keys)).join(table, HASH, "left")
            piece = F.pmod(own_hash, F.coalesce(F.col(PIECES), F.lit(1)))
            side = (
                side.withColumn(HASH, key_hash([F.col(renamed[k]) for k in keys]))
                .join(table, HASH, "left")
                .withColumn(
                    f"__side{SALT}",
                    F.explode(F.sequence(F.lit(0), F.coalesce(F.col(PIECES), F.lit(1)) - 1)),
                )
                .withColumn(f"__side{SALT}", F.col(f"__side{SALT}").cast("bigint"))
                .drop(HASH, PIECES)
            )
        else:
            piece = F.lit(0)
            side = side.withColumn(f"__side{SALT}", F.lit(0).cast("bigint"))
        if hot or not matchable:
            probe = probe.withColumn(
                SALT, F.when(found, piece).otherwise(own_hash).cast("bigint")
            )
            match = [*match, F.col(SALT) == F.col(f"__side{SALT}")]
        joined = probe.join(side, match, "left")
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"`{c}`") for c in taken])


def fill_from_lookup(
    df: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, Column | str],
    target: str,
    value: str,
    small: bool | None = None,
    hot: HotKeys | None = None,
    strict: bool = False,
) -> DataFrame:
    """Fill NULLs of ``target`` with ``value`` of the matching lookup row.

    Only rows whose target is NULL look anything up; a value already there is kept even
    where the lookup says otherwise. Column order stays.

    For a lookup too large to be sent to every executor, rows that lack the target and have the keys
    are joined, and all others pass beside them without a shuffle. ``df`` is read for both, so it
    should be stored.
    """
    source = one_per_key(lookup, list(on), [value], strict).withColumnRenamed(value, "__found")
    if small is None:
        small = is_small(lookup.select(*on, value))
    lacking = F.col(f"`{target}`").isNull()
    filled = [
        F.coalesce(F.col(target), F.col("__found")).alias(target) if c == target else F.col(f"`{c}`")
        for c in df.columns
    ]
    if small:
        return lookup_join(df, source, on, needed=lacking, small=True).select(*filled)
    wanting = lacking
    for key in on.values():
        wanting = wanting & _value(key).isNotNull()
    joined = lookup_join(df.filter(wanting), source, on, small=False, hot=hot, matchable=True)
    return joined.select(*filled).unionByName(df.filter(~wanting))
