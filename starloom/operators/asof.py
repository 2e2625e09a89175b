"""Lookups of the nearest row in time, by one window over both sides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.lookup import one_per_key
from starloom.operators.skew import HASH, PIECES, SALT, HotKeys, key_hash

_TIME, _SIDE, _FOUND = "__time", "__side", "__found"
DIRECTIONS = ("backward", "forward", "nearest")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, Column],
    left_time: Column,
    right_time: str,
    values: Sequence[str],
    direction: str = "nearest",
    needed: Column | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``left`` with ``values`` of the ``right`` row nearest in time among those equal in ``on``.

    ``on`` maps key columns of ``right`` to expressions on ``left``. ``backward`` takes the last row not
    after the left one's time, ``forward`` the first not before it, ``nearest`` the closer of both
    and the earlier of two equally close. Of several right rows at one time the smallest by values
    counts, so rows are not multiplied. Where nothing matches, where a key or time is NULL or
    ``needed`` does not hold, values are NULL.

    Both sides become one table, ordered by time inside each key; the last and next right
    row are carried along it. There is no join by range and no pairing of rows. Left rows that cannot
    match are spread by their own hash; an oversize key (``hot``) is dealt over copies of its right rows.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction is one of {DIRECTIONS}")
    keys = list(on)
    names = [f"__key_{k}" for k in keys]
    wanted = F.lit(True) if needed is None else F.coalesce(needed, F.lit(False))
    usable = right.filter(F.col(right_time).isNotNull())
    once = one_per_key(usable, [*keys, right_time], values)
    side = once.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.col(right_time).cast("timestamp").alias(_TIME),
        F.struct(F.col(right_time).cast("timestamp").alias("at"), *values).alias(_FOUND),
        F.lit(0).alias(_SIDE),
    )
    own_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    probe = left.withColumns({n: F.when(wanted, e) for n, e in zip(names, on.values(), strict=True)})
    probe = probe.withColumns({_TIME: F.when(wanted, left_time).cast("timestamp"), _SIDE: F.lit(1)})
    matchable = F.col(_TIME).isNotNull()
    for n in names:
        matchable = matchable & F.col(n).isNotNull()
    piece = F.lit(0)
    if hot:
        table = hot.table()
        hashed = key_hash([F.col(n) for n in names])
        pieces = F.coalesce(F.col(PIECES), F.lit(1))
        probe = probe.withColumn(HASH, hashed).join(table, HASH, "left")
        piece = F.pmod(own_hash, pieces)
        side = (
            side.withColumn(HASH, hashed).join(table, HASH, "left")
            .withColumn(SALT, F.explode(F.sequence(F.lit(0), pieces - 1)))
            .withColumn(SALT, F.col(SALT).cast("bigint")).drop(HASH, PIECES)
        )
    else:
        side = side.withColumn(SALT, F.lit(0).cast("bigint"))
    probe = probe.withColumn(SALT, F.when(matchable, piece).otherwise(own_hash).cast("bigint"))
    probe = probe.drop(HASH, PIECES)

    both = probe.unionByName(side, allowMissingColumns=True)
    group = [F.col(n) for n in [*names, SALT]]
    # Right rows come first at an equal time looking back, and last looking ahead.
    back = Window.partitionBy(F.xxhash64(*group), *group).orderBy(F.col(_TIME), F.col(_SIDE))
    earlier = F.last(_FOUND, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0))
    ahead = Window.partitionBy(F.xxhash64(*group), *group).orderBy(F.col(_TIME).desc(), F.col(_SIDE))
    later = F.last(_FOUND, ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, 0))
    seen = {"__earlier": earlier} if direction != "forward" else {}
    seen |= {"__later": later} if direction != "backward" else {}
    carried = both.withColumns(seen).filter(F.col(_SIDE) == 1)
    if direction == "nearest":
        before = F.unix_micros(_TIME) - F.unix_micros("__earlier.at")
        after = F.unix_micros("__later.at") - F.unix_micros(_TIME)
        found = F.when(F.coalesce(before <= after, F.col("__later").isNull()), F.col("__earlier")).otherwise(F.col("__later"))
    else:
        found = F.col("__earlier" if direction == "backward" else "__later")
    carried = carried.withColumn("__taken", F.when(matchable, found))
    return carried.select(
        *[F.col(f"`{c}`") for c in left.columns], *[F.col(f"__taken.{v}").alias(v) for v in values]
    )
