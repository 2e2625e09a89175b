"""Ranks inside groups and dense keys over whole tables, without oversize groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.skew import HASH, HotKeys, key_hash
from starloom.session import materialize

_SLOT = "__slot"
_SLOT_BITS = 33
_SPREAD = "__spread"
_OWN = "__own_row"


def total_order(
    df: DataFrame, order_by: Sequence[str], without: Sequence[str] = ()
) -> list[Column]:
    """``order_by``, then every other column, ascending with NULLs first.

    Rows that still tie are equal in every column, so any of them is the same row.
    """
    rest = [c for c in df.columns if c not in order_by and c not in without]
    return [F.col(f"`{c}`").asc_nulls_first() for c in [*order_by, *rest]]


def _groups(keys: Sequence[Column]) -> list[Column]:
    """Partition columns of a ranking, led by the number that the keys' text ends in, else by a hash of the keys.

    Rows are sorted by these first. A leading number settles almost every comparison on
    the sort's eight-byte prefix; identifiers with a common beginning settle none there. It
    is shuffled with every row, so four bytes have to do: keys that share them are told apart by themselves.
    Unlike a hash, the number of an id leaves rows beside those numbered just before, which often
    share text with them, and such rows are shuffled in fewer bytes. The key named first counts, if it is not NULL.
    """
    end = F.regexp_extract(F.concat_ws("", *[k.cast("string") for k in reversed(keys)]), "[0-9]{1,9}$", 0)
    return [F.coalesce(end.try_cast("int"), F.hash(*keys)), *keys]


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    ties: Sequence[str] | None = None,
    only: Column | None = None,
    row_id: str | None = None,
    hashed: str | None = None,
) -> DataFrame:
    """First row of each group; every row for which ``only`` is not true.

    The rank filter sits directly on the window, so Spark keeps one row per group in
    every map task before the shuffle: a group of any size sends one row per task.

    With ``only``, a column ``row_id`` unique among the other rows makes each of them a
    group of its own, and one pass does. Without it the rows are stored once to get one.

    ``hashed`` names a column to add, with the lead of the keys (see ``_groups``) that rows are dealt by. As long as it
    is there, a later step over groups of it and the keys needs no further shuffle.
    """
    if hashed is not None:
        if only is not None:
            raise ValueError("rows that are no group have no hash of it")
        df = df.withColumn(hashed, _groups([F.col(k) for k in keys])[0])
    if only is not None and row_id is None:
        numbered = materialize(df, "numbered", row_id=_OWN)
        tied = df.columns if ties is None else ties
        return keep_first(numbered, keys, order_by, tied, only, _OWN).drop(_OWN)
    frame = df.select(*ties) if ties is not None else df
    order = total_order(frame, order_by, without=[*keys, *([hashed] if hashed else [])])
    groups = [F.col(k) for k in keys]
    if only is not None:
        groups.append(F.when(F.coalesce(only, F.lit(False)), None).otherwise(F.col(row_id)))
    lead = [F.col(hashed), *groups] if hashed else _groups(groups)
    window = Window.partitionBy(*lead).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def deal(df: DataFrame, keys: Sequence[str], hashed: str) -> DataFrame:
    """``df`` shuffled by ``keys``; their lead (see ``_groups``) is added after that, as the column ``hashed``.

    Steps over groups of it and the keys need no further shuffle, and the lead takes no bytes in this one.
    """
    return df.repartition(*keys).withColumn(hashed, _groups([F.col(k) for k in keys])[0])


def rank_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    name: str = "row_num",
    eligible: Column | None = None,
    hot: HotKeys | None = None,
    ties: Sequence[str] | None = None,
    hashed: str | None = None,
) -> DataFrame:
    """Number the rows of each group from 1, as bigint; NULL for rows that are not eligible.

    Rows not eligible pass through spread by their own hash, so that, say, NULL keys do
    not meet in one task. Groups in ``hot`` are numbered by one distributed sort over all
    of them (:func:`dense_key`) less the number before their first row. The input is stored
    once then, as it is read for both kinds of groups.

    ``hashed`` names the column that :func:`deal` dealt the rows by; they are not shuffled again then.
    """
    if hashed is not None:
        if hot or eligible is not None:
            raise ValueError("rows dealt by their groups are ranked there, all of them")
        frame = df.select(*ties) if ties is not None else df
        window = Window.partitionBy(hashed, *keys).orderBy(*total_order(frame, order_by, without=[*keys, hashed]))
        return df.withColumn(name, _position(window))
    take_part = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    if not hot:
        return _window_rank(df, keys, order_by, name, take_part, eligible is not None, ties)

    hot_table = hot.table().select(HASH)
    df = materialize(df, "ranked")
    marked = df.withColumn(HASH, F.when(take_part, key_hash([F.col(k) for k in keys])))
    cold = marked.join(hot_table, HASH, "left_anti").drop(HASH).select(*df.columns)
    large = marked.join(hot_table, HASH, "left_semi").drop(HASH).select(*df.columns)

    rest = [c for c in (ties or df.columns) if c not in keys and c not in order_by]
    placed = dense_key(large, [*keys, *order_by, *rest], "__place")
    # One row per hot group: bounded like the hot table itself.
    firsts = placed.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.min("__place").alias("__first")
    )
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    side = F.broadcast(firsts) if hot.fits() else firsts
    numbered = placed.join(side, same, "inner").select(
        *df.columns, (F.col("__place") - F.col("__first") + 1).alias(name)
    )
    usual = _window_rank(cold, keys, order_by, name, take_part, eligible is not None, ties)
    return usual.unionByName(numbered)


def _position(window) -> Column:
    """Row number as bigint; ``row_number`` itself ends at 2^31."""
    return F.count(F.lit(1)).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _window_rank(df, keys, order_by, name, take_part, spread, ties) -> DataFrame:
    frame = df.select(*ties) if ties is not None else df
    order = total_order(frame, order_by, without=keys)
    if not spread:
        window = Window.partitionBy(*_groups([F.col(k) for k in keys])).orderBy(*order)
        return df.withColumn(name, _position(window))
    apart = F.when(take_part, F.lit(0)).otherwise(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    window = Window.partitionBy(*_groups([F.col(k) for k in [*keys, _SPREAD]])).orderBy(*order)
    return (
        df.withColumn(_SPREAD, apart)
        .withColumn(name, _position(window))
        .withColumn(name, F.when(take_part, F.col(name)))
        .drop(_SPREAD)
    )


def dense_key(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    row_id: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Number all rows 1..n in the given order, as one global ``row_number`` would.

    A global window sorts the whole table in one task. Here Spark's range-partitioned
    sort does the ordering, the sorted rows are stored with the partition and position
    they were written at, and each partition's first number follows from the sizes of
    those before it: one shuffle, no window.

    ``row_id`` names a column that is unique and stored (see ``materialize``). It is the
    last sort key, so even equal rows split over range boundaries instead of piling up
    in one partition. Without it the rows are stored once first to get one, which also
    spares the boundary sampling a second run of the upstream plan. ``row_id`` is dropped.
    Rows known to be ``unique`` as a whole need neither: no run of equal rows can fill a partition.
    """
    if row_id is None and not unique:
        row_id = "__row_id"
        df = materialize(df, "numbered", row_id=row_id)
    order = total_order(df, order_by, without=[row_id] if row_id else [])
    if row_id:
        order.append(F.col(row_id))
    ordered = df.orderBy(*order)
    placed = materialize(ordered.drop(row_id) if row_id else ordered, "sorted", row_id=_SLOT)

    part = F.shiftright(_SLOT, _SLOT_BITS)
    sizes = placed.groupBy(part.alias("part")).count().collect()  # one row per sort partition
    before, starts = 0, []
    for row in sorted(sizes, key=lambda r: r["part"]):
        starts.append((row["part"], before))
        before += row["count"]
    offsets = df.sparkSession.createDataFrame(starts, "__part bigint, __before bigint")
    position = F.col(_SLOT).bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), part == F.col("__part"), "inner")
        .withColumn(name, F.col("__before") + position + 1)
        .drop(_SLOT, "__part", "__before")
    )
