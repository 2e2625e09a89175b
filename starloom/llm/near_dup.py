"""MinHash near-duplicates by an inverted join on signature coordinates.

1. Every text becomes its set of hashed shingles, and the set its signature of ``COORDS``
   minima. Equal sets are one class from here on, so exact copies cost nothing further.
2. Classes are posted under each (coordinate, value) pair. Two classes of the wanted
   similarity agree in at least ``need`` coordinates (missed once in a million borderline
   pairs). A value with one class is dropped, and with it every class that has fewer than
   ``need`` values left: it can be near nobody. What stays is counted once more.
3. Prefix: of a class's values, rarest first, only the first ``left - need + 1`` are
   joined, as two classes that agree in ``need`` values share one of these.
4. A value's classes are compared with its pivot, and what the exact sets confirm is merged
   into components. Members of one component are never compared again.
5. Skip: with d(x) = x without and plus what tells it from the pivot, the difference of two
   members is |d(x)| + |d(y)| - 2 |d(x) & d(y)|, and what they share of it is at most what
   x shares with members of other components. So least and largest figures per value and component
   prove for almost every member of a large group that no other component has a partner
   for it, without looking at pairs. Members far from the pivot are skipped by the triangle
   inequality of signatures. Neither drops a pair that could be linked.
6. Members not skipped meet those of other components where they share a rare part of what
   tells them from the pivot. Collisions are counted there, and pairs that agree in ``need``
   coordinates are confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import batches_of, lower_bytes, materialize, removing_intermediates
from starloom.llm.components import components

COORDS = 64
#: Members that differ from the pivot in so many coordinates at most are measured exactly.
NEAR = COORDS // 2
#: Words remembered by a task, to hash each once.
WORDS = 100_000
CHUNK_BYTES = 4 << 20

_random = np.random.Generator(np.random.PCG64(20))
_XOR = _random.integers(0, 2**64, COORDS, np.uint64)
_ODD = _random.integers(0, 2**63, COORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def needed(similarity: float, coords: int = COORDS, miss: float = 1e-6) -> int:
    """Agreeing coordinates that a pair of this similarity reaches but for chance ``miss``."""
    below = 0.0
    for n in range(coords + 1):
        below += math.comb(coords, n) * similarity**n * (1 - similarity) ** (coords - n)
        if below > miss:
            return max(1, n)
    return coords


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, size: int):
        self.size, self.hashes = size, {}

    def _word(self, word: bytes) -> int:
        found = self.hashes.get(word)
        if found is None:
            if len(self.hashes) >= WORDS:
                self.hashes.clear()
            found = self.hashes[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        words = lower_bytes(text).split()  # at exactly these bytes: \x20 \x09-\x0D
        h = np.fromiter(map(self._word, words), np.uint64, len(words))
        size = min(self.size, h.size)
        if not size:
            return h
        mixed = np.full(h.size - size + 1, size, np.uint64)
        for i in range(size):
            mixed = (mixed ^ h[i : h.size - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        mixed.sort()
        keep = np.ones(mixed.size, bool)
        keep[1:] = mixed[1:] != mixed[:-1]
        return mixed[keep]


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(COORDS, 2**32 - 1, np.uint64)
    for at in range(0, shingles.size, 512):
        part = (shingles[at : at + 512, None] ^ _XOR) * _ODD
        np.minimum(least, part.min(axis=0) >> np.uint64(32), out=least)
    return least.astype(np.int64)


def class_of(shingles: np.ndarray) -> int:
    """Number of a set: 63 bits of its digest. Empty sets have none."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little") >> 1


def _signed(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    names = ["id", "n_shingles", "cls", "sig"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches_of(batches, "text", CHUNK_BYTES):
            n, cls, sig = [], [], []
            for text in batch.column("text").to_pylist():
                shingles = shingler(text)
                n.append(shingles.size)
                cls.append(class_of(shingles) if shingles.size else None)
                sig.append(signature(shingles) if shingles.size else None)
            columns = [batch.column("id"), *[pa.array(x, k) for x, k in zip((n, cls, sig), kinds[1:], strict=True)]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return plain.mapInArrow(sign, "id long, n_shingles long, cls long, sig array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``cls, shingles`` of the wanted (id, cls): their texts are read again, no others."""
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    some = plain.join(wanted.select("id", "cls"), "id")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches_of(batches, "text", CHUNK_BYTES):
            cls, sets = [], []
            for text, c in zip(batch.column("text").to_pylist(), batch.column("cls").to_pylist(), strict=True):
                shingles = shingler(text)
                if shingles.size and class_of(shingles) == c:
                    cls.append(c)
                    sets.append(shingles.view(np.int64))
            arrays = [pa.array(cls, pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["cls", "shingles"])

    return some.mapInArrow(build, "cls long, shingles array<long>")


def _shared(classes: DataFrame) -> DataFrame:
    """``cls, key, often``: every value of a class that others have, and how many classes do."""
    coordinate = F.col("at").cast("long") * F.lit(1 << 32) + F.col("value")
    posted = classes.select("cls", F.posexplode("sig").alias("at", "value")).select(
        "cls", coordinate.alias("key")
    )
    often = posted.groupBy("key").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    return posted.join(often, "key")


def _rare_first(classes: DataFrame, need: int) -> DataFrame:
    """Classes that share at least ``need`` values with others; ``shared``: those, rarest first."""
    listed = F.sort_array(F.collect_list(F.struct("often", "key"))).alias("shared")
    found = _shared(classes).groupBy("cls").agg(listed).filter(F.size("shared") >= need)
    return found.join(classes.select("cls", "n"), "cls")


def _agree(one: Column, two: Column) -> Column:
    """Number of equal coordinates."""
    equal = F.zip_with(one, two, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda n, x: n + x)


def _away(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` of classes ``a, b`` plus ``away``, the number of differing coordinates."""
    signed = classes.select("cls", "sig")
    return (
        pairs.join(signed.select(F.col("cls").alias("a"), F.col("sig").alias("sa")), "a")
        .join(signed.select(F.col("cls").alias("b"), F.col("sig").alias("sb")), "b")
        .select("a", "b", (COORDS - _agree(F.col("sa"), F.col("sb"))).alias("away"))
    )


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    return pairs.join(
        sets.select(F.col("cls").alias("a"), F.col("shingles").alias("xa")), "a"
    ).join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("xb")), "b")


def _linked(n: Column, m: Column, differ: Column, percent: int) -> Column:
    """Whether sets of n and m elements that differ in ``differ`` have the similarity."""
    return (n + m - differ) * 100 >= (n + m + differ) * percent


def _open_rows(member: DataFrame, measured: DataFrame, labels: DataFrame, percent: int):
    """Members of values with several components, and what each shares of its difference.

    ``rows``: a row per value and member. ``slack`` and ``share`` are |d(x)| and twice the
    part of d(x) that another component has, both times 100 + percent, the former less what
    the sizes allow: x and y can be linked only if slack(x) + slack(y) <= min(share(x), share(y)).
    ``told``: that part of d(x), its elements with the number of members that have each, rarest first.
    """
    has = F.col("delta").isNotNull()
    told = measured.select(F.col("a").alias("pivot"), F.col("b").alias("cls"), "away", "delta")
    named = member.join(labels.select(F.col("node").alias("cls"), "label"), "cls")
    mixed = named.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1"))
    open_ = materialize(
        named.join(mixed.filter("l0 <> l1").select("key"), "key").join(
            told.select("pivot", "cls", "away", F.when(has, F.size("delta")).alias("differ")),
            ["pivot", "cls"],
        ),
        "open",
    )
    apart = open_.filter("differ IS NOT NULL").select("pivot", "cls", "label").distinct()
    told = told.filter(has).select("pivot", "cls", "delta").join(apart, ["pivot", "cls"])
    told = told.select("pivot", "cls", "label", F.explode("delta").alias("e"))
    common = told.groupBy("pivot", "e").agg(
        F.min("label").alias("l0"), F.max("label").alias("l1"), F.count(F.lit(1)).alias("often")
    )
    common = common.filter("l0 <> l1").select("pivot", "e", "often")
    parts = F.sort_array(F.collect_list(F.struct("often", "e")))
    told = told.drop("label").join(common, ["pivot", "e"]).groupBy("pivot", "cls").agg(parts.alias("parts"))
    told = materialize(told, "told")
    share = told.select("pivot", "cls", (F.size("parts").cast("long") * (2 * (100 + percent))).alias("share"))
    near = F.col("differ").isNotNull()
    slack = F.col("differ") * (100 + percent) - F.col("n") * (100 - percent)
    rows = open_.join(share, ["pivot", "cls"], "left").select(
        "key", "pivot", "cls", "n", "prefix", "label", "away",
        near.alias("near"),
        F.when(near, slack).alias("slack"),
        F.coalesce("share", F.lit(0)).alias("share"),
    )
    return materialize(rows, "rows"), told


def _unskipped(rows: DataFrame, need: int, percent: int) -> DataFrame:
    """Rows that may have a partner in another component, ``meets_near`` or ``meets_far`` the pivot.

    ``overlap``: how much of d(x) a partner near the pivot has at least.
    """
    near, far = F.col("near"), ~F.col("near")
    by_label = rows.filter(near).groupBy("key", "label").agg(
        F.min("slack").alias("slack"), F.min(F.col("slack") - F.col("share")).alias("net")
    )
    first = by_label.groupBy("key").agg(
        F.min(F.struct("slack", "label")).alias("s1"), F.min(F.struct("net", "label")).alias("n1")
    )
    second = by_label.join(first, "key").groupBy("key").agg(
        F.min(F.when(F.col("label") != F.col("s1.label"), F.col("slack"))).alias("s2"),
        F.min(F.when(F.col("label") != F.col("n1.label"), F.col("net"))).alias("n2"),
        F.first("s1").alias("s1"),
        F.first("n1").alias("n1"),
    )
    spread = rows.groupBy("key").agg(
        F.count_if(near).alias("nears"),
        F.count_if(far).alias("fars"),
        F.min(F.when(far, F.col("away"))).alias("least_far"),
        F.max(F.when(near, F.col("away"))).alias("most_near"),
    )
    seen = rows.join(spread, "key").join(second, "key", "left")
    other_slack = F.when(F.col("label") == F.col("s1.label"), F.col("s2")).otherwise(F.col("s1.slack"))
    other_net = F.when(F.col("label") == F.col("n1.label"), F.col("n2")).otherwise(F.col("n1.net"))
    least = F.col("slack") + other_slack
    partner_near = (least <= F.col("share")) & (F.col("slack") + other_net <= 0)
    reach = COORDS - need
    meets_near = near & F.coalesce(partner_near, F.lit(False))
    meets_far = F.when(near, (F.col("fars") > 0) & (F.col("least_far") - F.col("away") <= reach)).otherwise(
        (F.col("fars") > 1) | ((F.col("nears") > 0) & (F.col("away") - F.col("most_near") <= reach))
    )
    return seen.select(
        *rows.columns,
        meets_near.alias("meets_near"),
        F.coalesce(meets_far, F.lit(False)).alias("meets_far"),
        F.greatest(F.lit(1), F.ceil(least / (2 * (100 + percent)))).cast("int").alias("overlap"),
    ).filter("meets_near OR meets_far")


def _first_common(one: Column, two: Column) -> Column:
    return F.array_intersect(one, two)[0]


def _pairs(rows: DataFrame, on: list[str], prefix: str, first: str, also, percent: int) -> DataFrame:
    """Pairs ``a < b`` of rows equal in ``on``, of different components and fitting sizes.

    Each is made once, where ``first`` is the first value that the prefixes of both have.
    """
    one, two = rows.alias("x"), rows.alias("y")

    def x(name: str) -> Column:
        return F.col(f"x.{name}")

    def y(name: str) -> Column:
        return F.col(f"y.{name}")

    fits = (x("cls") < y("cls")) & (x("label") != y("label"))
    fits &= F.least(x("n"), y("n")) * 100 >= F.greatest(x("n"), y("n")) * percent
    for name in on:
        fits &= x(name) == y(name)
    fits &= also(x, y) & (x(first) == _first_common(x(prefix), y(prefix)))
    return one.join(two, fits).select(x("cls").alias("a"), y("cls").alias("b"))


def _across(
    rows: DataFrame, told: DataFrame, member: DataFrame, classes: DataFrame, need: int, percent: int
) -> DataFrame:
    """Pairs of different components that agree in ``need`` coordinates, each once.

    A pair is judged at the first value it shares; skipped there, it is proven not to be
    linked. Both near that value's pivot: partners share at least ``overlap`` elements of
    their differences from it, so they meet at one of the first few, rarest first.
    Otherwise they meet at the value itself.
    """
    seen = rows.filter("meets_near").groupBy("pivot", "cls").agg(
        F.min("overlap").alias("overlap"),
        *[F.first(c).alias(c) for c in ("n", "label", "slack", "share", "prefix")],
    )
    # The values of a class that have this pivot.
    own = member.join(seen.select("pivot", "cls"), ["pivot", "cls"]).groupBy("pivot", "cls").agg(
        F.collect_list("key").alias("own")
    )
    listed = told.join(seen.select("pivot", "cls", "overlap"), ["pivot", "cls"])
    rarest = listed.filter("size(parts) >= overlap").select(
        "pivot", "cls", F.expr("slice(parts, 1, size(parts) - overlap + 1).e").alias("parts")
    )
    narrow = F.transform("sig", lambda v: (v - F.lit(1 << 31)).cast("int"))
    signed = classes.select("cls", narrow.alias("sig"))
    near = seen.join(rarest, ["pivot", "cls"]).join(own, ["pivot", "cls"]).join(signed, "cls")
    near = near.withColumn("e", F.explode("parts"))

    def alike(x, y):
        return _agree(x("sig"), y("sig")) >= need

    by_part = _pairs(
        near, ["pivot", "e"], "parts", "e",
        lambda x, y: (x("slack") + y("slack") <= F.least(x("share"), y("share")))
        & F.exists(y("prefix"), lambda k: F.array_contains(x("prefix"), k))
        & F.array_contains(x("own"), _first_common(x("prefix"), y("prefix")))
        & alike(x, y),
        percent,
    )
    far = rows.filter("meets_far").join(signed, "cls")
    by_key = _pairs(
        far, ["key"], "prefix", "key",
        lambda x, y: ~(x("near") & y("near"))
        & (F.abs(x("away") - y("away")) <= COORDS - need)
        & alike(x, y),
        percent,
    )
    return by_part.unionByName(by_key)


def _labels(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``node, label`` of every class; a class without links is its own."""
    tied = components(links)
    named = rows.select(F.col("cls").alias("node")).join(tied, "node", "left")
    return materialize(named.select("node", F.coalesce("label", "node").alias("label")), "labels")


def _components_of(
    docs: DataFrame, classes: DataFrame, shingle: int, percent: int, id_col: str, text_col: str
) -> DataFrame:
    """``cls, component`` of every class that may be linked: the least id of its component."""
    need = needed(percent / 100)
    # Those dropped make values rare that they held; counting again drops more.
    counted = _shared(classes).groupBy("cls").agg(F.count(F.lit(1)).alias("values"))
    hopeful = materialize(counted.filter(F.col("values") >= need).select("cls"), "hopeful")
    near = classes.join(hopeful, "cls", "left_semi")
    kept = materialize(
        _rare_first(near, need).select(
            "cls",
            "n",
            F.expr(f"slice(shared, 1, size(shared) - {need - 1})").alias("prefix"),
            F.aggregate("shared", F.lit(0).cast("long"), lambda n, v: n + v["often"]).alias("weight"),
        ),
        "prefixes",
    )
    rows = classes.join(kept.select("cls"), "cls", "left_semi")
    rows = materialize(rows, "near")
    sets = materialize(_sets(docs, rows, id_col, text_col, shingle).dropDuplicates(["cls"]), "sets")
    posted = kept.select(
        "cls", "n", "weight", F.col("prefix.key").alias("prefix"), F.explode("prefix.key").alias("key")
    )
    # The pivot is the most typical member, whose values the most others have.
    pivots = posted.groupBy("key").agg(
        F.max_by("cls", F.struct("weight", "cls")).alias("pivot"), F.count(F.lit(1)).alias("many")
    )
    member = posted.join(pivots.filter("many > 1"), "key").select("key", "cls", "n", "prefix", "pivot")
    member = materialize(member, "member")
    duo = member.select(F.col("pivot").alias("a"), F.col("cls").alias("b")).distinct()
    duo = materialize(_away(duo, rows), "duo")
    delta = F.concat(F.array_except("xa", "xb"), F.array_except("xb", "xa"))
    near_pivot = _with_sets(duo.filter(F.col("away") <= NEAR), sets).select(
        "a", "b", "away", F.size("xa").alias("n"), F.size("xb").alias("m"), delta.alias("delta")
    )
    none = F.lit(None)
    far = duo.filter(F.col("away") > NEAR).select(
        "a", "b", "away", none.cast("int").alias("n"), none.cast("int").alias("m"),
        none.cast("array<long>").alias("delta"),
    )
    measured = materialize(near_pivot.unionByName(far), "measured")
    links = measured.filter(
        (F.col("a") != F.col("b")) & _linked(F.col("n"), F.col("m"), F.size("delta"), percent)
    ).select("a", "b")
    links = materialize(links, "links")
    labels = _labels(rows, links)
    open_, told = _open_rows(member, measured, labels, percent)
    unskipped = materialize(_unskipped(open_, need, percent), "unskipped")
    rest = _across(unskipped, told, member, rows, need, percent)
    likely = _with_sets(rest, sets)
    differ = F.size("xa") + F.size("xb") - 2 * F.size(F.array_intersect("xa", "xb"))
    found = likely.filter(_linked(F.size("xa"), F.size("xb"), differ, percent)).select("a", "b")
    found = materialize(found, "links")
    if not found.isEmpty():
        labels = _labels(rows, links.unionByName(found))
    named = rows.select("cls", "id").join(labels.withColumnRenamed("node", "cls"), "cls")
    smallest = named.groupBy("label").agg(F.min("id").alias("component"))
    return materialize(named.join(smallest, "label").select("cls", "component"), "components", keep=True)


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are what lies between ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z; the set of a text is
    its distinct shingles of ``shingle`` words, one of all its words when it has fewer.
    Documents are linked when 100 * intersection >= ``percent`` * union; ``component_id`` is
    the least id reachable, and the document with it is ``kept``.

    A NULL, empty or blank text has the empty set, is linked with nothing and kept. Copies are
    one class. Rows that repeat an id stay rows, all with the same ids. A row with a NULL id
    is in no component: NULL ``component_id``, kept. Only the named columns are read, so
    others may have any name. An empty table gives an empty table.
    """
    signed = materialize(_signed(docs, id_col, text_col, shingle), "signed", keep=True)
    classes = materialize(
        signed.filter("cls IS NOT NULL AND id IS NOT NULL")
        .groupBy("cls")
        .agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")),
        "classes",
        keep=True,
    )
    with removing_intermediates(docs.sparkSession):
        of_near = _components_of(docs, classes, shingle, percent, id_col, text_col)
    component = classes.select("cls", "id").join(of_near, "cls", "left").select(
        "cls", F.coalesce("component", "id").alias("component")
    )
    # Only classes that lead away from a document itself are joined to the documents.
    counts = signed.groupBy("cls").agg(F.count(F.lit(1)).alias("copies"))
    moved = component.join(classes.select("cls", "id"), "cls").join(counts, "cls").filter(
        "copies > 1 OR component <> id"
    ).select("cls", "component")
    reached = F.coalesce("component", "id")
    return signed.join(moved, "cls", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(F.col("id").isNotNull(), reached).alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == reached)).alias("kept"),
    )
