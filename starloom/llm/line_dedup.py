"""Removal of lines that many documents share, in DataFrame functions only.

Lines are exploded with their position and reduced to a 128-bit hash of their normalised form;
these rows of numbers are stored. What is shuffled for counting is one row of three numbers per
distinct line of a document, never its text. The positions of lines that go meet the lines of
their document again, and what stays is joined in order, in time linear in the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import ascii_lower, materialize

SPACES = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(SPACES)))


def _hash(key: Column) -> Column:
    """128 bits: two hashes that share no seed."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Columns of ``docs`` with the text cleaned, plus ``n_lines`` and ``n_dropped``.

    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents
    lose all their lines but those of the largest id that holds them. The other lines
    stay, in their order.

    A NULL text becomes one empty line, as an empty text is. Rows with a NULL id stay as they
    are and count for no line. Rows that share an id are one document: a line counts once
    for it and goes from all its rows. Columns of other names pass through, those named
    ``n_lines`` or ``n_dropped`` are replaced. An empty table gives an empty table.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.split(text, "\n", -1)
    # Rows that share an id may differ in their text, which tells whose position it is.
    held = (
        docs.filter(F.col(f"`{id_col}`").isNotNull() & (F.length(text) >= min_chars))
        .select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("row"), F.posexplode(lines).alias("pos", "line"))
        .filter(F.length("line") >= min_chars)
        .select("id", "row", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("id", "row", "pos", _hash(F.col("key")).alias("h"))
        .select("id", "row", "pos", "h.a", "h.b")
    )
    held = materialize(held, "lines")
    shared = (
        held.select("id", "a", "b").distinct().groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper"))
        .filter(F.col("n") >= min_docs)
        .select("a", "b", "keeper")
    )
    # Repeated rows give a position more than once.
    gone = (
        held.join(shared, ["a", "b"])
        .filter(F.col("id") < F.col("keeper"))
        .groupBy(F.col("id").alias("__id"), F.col("row").alias("__same"))
        .agg(F.array_distinct(F.collect_list("pos")).alias("__gone"))
    )
    others = [F.col(f"`{c}`") for c in names if c not in (text_col, id_col)]
    plain = docs.select(
        F.col(f"`{id_col}`").alias("__own"), *others, lines.alias("__lines"), F.xxhash64(text).alias("__text")
    )
    joined = plain.join(
        gone.hint("shuffle_hash"), (F.col("__own") == F.col("__id")) & (F.col("__text") == F.col("__same")), "left"
    )
    every = F.sequence(F.lit(0), F.size("__lines") - 1)
    kept = F.transform(F.array_except(every, "__gone"), lambda at: F.get(F.col("__lines"), at))
    cleaned = F.array_join(F.when(F.col("__gone").isNull(), F.col("__lines")).otherwise(kept), "\n")
    own = {id_col: F.col("__own").alias(id_col), text_col: cleaned.alias(text_col)}
    return joined.select(
        *[own.get(c, F.col(f"`{c}`")) for c in names],
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
