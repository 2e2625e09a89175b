"""Groups too large for one task, and sides small enough to broadcast.

Both answers only choose a physical path. Whatever they say, the rows that come out of
the operators using them are the same, so a sample is enough here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize

HASH = "__key_hash"
PIECES = "__pieces"
SALT = "__salt"

#: Rows of a group beyond which it is split, and the share of rows looked at to find such groups.
GROUP_ROWS = 5_000_000
SAMPLE = 0.001
#: Oversize groups up to which their table is broadcast.
BROADCAST_GROUPS = 100_000


def key_hash(keys: Sequence[Column]) -> Column:
    """64-bit hash of a key, the same for equal keys of differently typed columns."""
    return F.xxhash64(*[k.cast("string") for k in keys])


@dataclass(frozen=True)
class HotKeys:
    """Hash of each oversize group, and into how many pieces to split it, as a stored table.

    It has at most rows / ``GROUP_ROWS`` rows, however many that is, and is broadcast while
    it has few.
    """

    frame: DataFrame | None = None
    groups: int = 0

    def __bool__(self) -> bool:
        return self.groups > 0

    def fits(self) -> bool:
        """Whether one row per group may be sent to every executor."""
        return self.groups <= BROADCAST_GROUPS

    def table(self) -> DataFrame:
        return F.broadcast(self.frame) if self.fits() else self.frame


def hot_keys(
    df: DataFrame,
    keys: Sequence[Column | str],
    where: Column | None = None,
    group_rows: float = GROUP_ROWS,
    sample: float = SAMPLE,
) -> HotKeys:
    """Groups of ``keys`` with more than ``group_rows`` rows, estimated from a sample."""
    return hot_keys_of(df, [(keys, where)], group_rows, sample)[0]


def hot_keys_of(
    df: DataFrame,
    groupings: Sequence[tuple[Sequence[Column | str], Column | None]],
    group_rows: float = GROUP_ROWS,
    sample: float = SAMPLE,
) -> list[HotKeys]:
    """Oversize groups of several keys, each among the rows its condition holds for.

    One job that reads only the columns named; hashes are counted map-side, and what is
    found is stored. The driver receives one number per grouping. Groups missed by the
    sample take the ordinary path, which is exact too.
    """
    if sample < 1.0:
        df = df.sample(fraction=sample, seed=7)
    hashes = []
    for keys, where in groupings:
        columns = [F.col(k) if isinstance(k, str) else k for k in keys]
        hashes.append(key_hash(columns) if where is None else F.when(where, key_hash(columns)))
    counted = (
        df.select(F.posexplode(F.array(*hashes)).alias("grouping", HASH))
        .filter(F.col(HASH).isNotNull())
        .groupBy("grouping", HASH)
        .count()
        .filter(F.col("count") > group_rows * sample)
    )
    pieces = F.greatest(F.lit(2), F.ceil(F.col("count") / (sample * group_rows)).cast("int"))
    found = materialize(counted.select("grouping", HASH, pieces.alias(PIECES)), "hot")
    sizes = {r["grouping"]: r["count"] for r in found.groupBy("grouping").count().collect()}
    return [
        HotKeys(found.filter(F.col("grouping") == i).select(HASH, PIECES), sizes[i])
        if i in sizes
        else HotKeys()
        for i in range(len(groupings))
    ]


def is_small(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 32 << 20) -> bool:
    """Whether the frame is proven small enough to send to every executor.

    Reads no more than ``max_rows + 1`` rows past the limit and returns one row.
    """
    width = F.lit(0)
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) + 8
    seen = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    )
    row = seen.first()
    return row["rows"] <= max_rows and row["bytes"] <= max_bytes


def gather(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the rows of each key together, for writing one folder per key.

    Adaptive execution splits keys over the advisory size into several tasks and merges
    small ones, by the sizes it measures while the rows are shuffled.
    """
    return df.hint("rebalance", *[F.col(f"`{k}`") for k in keys])
