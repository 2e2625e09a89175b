"""Packing of tokenised documents into sequences, by repeated patterns of few documents.

Only the histogram of piece lengths reaches the driver: at most ``capacity`` counts, whatever
the size of the corpus. There, patterns of few documents that fill a sequence or leave little of it
unused are fitted to it by non-negative least squares, their repeat counts rounded, and what is
left packed by best fit, again as repeated patterns. The plan has a bounded number of rows and says, for
the r-th piece of a length, which sequence and place it takes. Pieces are numbered per length
within the file part that holds them, plus one offset per part and length.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import batches_of, materialize

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
CHUNK_BYTES = 2 << 20
SWEEPS = 30
HOT = 8
#: Letters, marks and spaces that every splitter classifies alike.
PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ſ]*")


class Encoder:
    """Token ids of texts, without special tokens added.

    ``tokenizers`` defines the ids. Texts of plain Latin letters go through the same vocabulary
    in ``tiktoken``, which gives the same ids several times faster; all others, and those
    that hold the vocabulary's special token, through ``tokenizers`` itself.
    """

    def __init__(self, vocabulary: str, ranks: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary)
        self.fast = None
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            pattern = public_tokenizers.PATTERN
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={}
            )

    def __call__(self, text: str) -> list[int]:
        plain = self.fast and PLAIN.fullmatch(text) and not any(s in text for s in self.special)
        if plain:
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: all but the first are full."""
    first = (length - 1) % capacity + 1
    return [(0, first), *[(at, capacity) for at in range(first, length, capacity)]]


def tokenize(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    ranks: str | None = None,
    end_id: int = 0,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of documents: id, piece, start, length, ids_crc32 and, if wanted, their ids.

    The tokenizer's files are read where the tasks run, as a part of the installed library.
    """
    names = [id_col, "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * keep_ids]
    kind = docs.schema[id_col].dataType
    ddl = "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    schema = T.StructType([T.StructField(id_col, kind), *T.StructType.fromDDL(ddl).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(
            vocabulary or public_tokenizers.path(VOCABULARY),
            (ranks or public_tokenizers.path(RANKS)) if vocabulary is None or ranks else None,
        )
        for batch in batches_of(batches, text_col, CHUNK_BYTES):
            owner, columns = [], [[] for _ in kinds]
            for row, text in enumerate(batch.column(text_col).to_pylist()):
                ids = np.array([*encode(text or ""), end_id], "<u4")
                for piece, (start, length) in enumerate(cut(ids.size, capacity)):
                    part = ids[start : start + length]
                    owner.append(row)
                    values = (piece, start, length, zlib.crc32(part.tobytes()), part.view("<i4"))
                    for column, value in zip(columns, values, strict=False):
                        column.append(value)
            first = batch.column(id_col).take(pa.array(owner, pa.int64()))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([first, *arrays], names=names)

    plain = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return plain.mapInArrow(run, schema)


def patterns_of(counts: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Patterns of one to four lengths in use, and repeats of one, longest first.

    The last length fills the sequence exactly or, if there is none such, is the longest that fits,
    so every length in use has patterns, with or without unused tokens.
    """
    used = np.flatnonzero(counts)
    used = used[used > 0]
    if not used.size:
        return []
    # By space: the longest length in use that fits into it, 0 if none does.
    fits = np.zeros(capacity + 1, np.int64)
    fits[used] = used
    fits = np.maximum.accumulate(fits).tolist()
    common = used[np.argsort(-counts[used], kind="stable")][:3].tolist()
    spread = used[np.linspace(0, used.size - 1, 3).astype(int)].tolist()
    found = set()

    def add(*pattern: int) -> None:
        last = fits[capacity - sum(pattern)]
        found.add(tuple(sorted((*pattern, *[last] * (last > 0)), reverse=True)))

    for a in used.tolist():
        rest = capacity - a
        add(a)
        found.add((a,) * min(capacity // a, int(counts[a])))
        for b in {*common, *spread, fits[rest], fits[rest // 2], fits[rest // 3]}:
            if 0 < b <= rest:
                add(a, b)
                if 2 * b <= rest:
                    add(a, b, b)
    # Rare lengths bound the patterns that they fill; the commonest ones are combined without them too.
    hot = sorted(used[np.argsort(-counts[used], kind="stable")][:HOT].tolist(), reverse=True)
    for size in range(1, 5):
        found.update(p for p in combinations_with_replacement(hot, size) if sum(p) <= capacity)
    return sorted(found, reverse=True)


def fit(patterns: list[tuple[int, ...]], counts: np.ndarray, capacity: int) -> np.ndarray:
    """Repeat counts x >= 0 with the least squared error of (pattern lengths) x against ``counts``.

    The unused tokens of a pattern weigh in as an error of their part of a sequence, and fuller patterns
    come first, so others take only what those leave.
    """
    left, x = counts.astype(float).copy(), np.zeros(len(patterns))
    slack = [1 - sum(p) / capacity for p in patterns]
    uses = [np.unique(p, return_counts=True) for p in patterns]
    most = [float((counts[lengths] // times).min()) for lengths, times in uses]  # a rare length bounds its patterns
    order = sorted(range(len(patterns)), key=slack.__getitem__)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in order:
            lengths, times = uses[j]
            step = (float(left[lengths] @ times) - slack[j]) / float(times @ times)
            step = min(max(step, -x[j]), most[j] - x[j])
            if step:
                x[j] += step
                left[lengths] -= step * times
                moved = max(moved, abs(step))
        if moved < 0.01:
            break
    return x


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns for what is left: the longest piece, then again the longest that fits."""
    left, plan = left.copy(), []
    while (used := np.flatnonzero(left)).size:
        taken, space = {}, capacity
        here = used.tolist()
        while here and space:
            at = np.searchsorted(here, space, side="right") - 1
            if at < 0:
                break
            length = here[at]
            taken[length] = taken.get(length, 0) + 1
            space -= length
            if taken[length] == left[length]:
                del here[at]
        times = min(int(left[n]) // m for n, m in taken.items())
        plan.append((tuple(n for n, m in sorted(taken.items(), reverse=True) for _ in range(m)), times))
        for n, m in taken.items():
            left[n] -= m * times
    return plan


def plan_patterns(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used; together they hold every piece exactly once."""
    left, used = counts.copy(), {}
    patterns = patterns_of(counts, capacity)
    fitted = sorted(zip(patterns, fit(patterns, counts, capacity), strict=True), key=lambda p: -p[1])
    # Rounded down at first; then full ones up, by the largest remainders, as far as there are pieces left.
    for up in (0, 1):
        for pattern, x in fitted if not up else sorted(fitted, key=lambda p: int(p[1]) - p[1]):
            if up and x == int(x):
                break
            if up and sum(pattern) < capacity:
                continue
            lengths, times = np.unique(pattern, return_counts=True)
            repeat = min(1 if up else int(x), int((left[lengths] // times).min()))
            if repeat:
                used[pattern] = used.get(pattern, 0) + repeat
                left[lengths] -= repeat * times
    return [*used.items(), *_best_fit(left, capacity)]


def slots(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, pieces of it in a sequence, first sequence, first offset), sorted."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            m = pattern.count(length)
            rows.append((length, rank.get(length, 0), m, sequence, offset))
            rank[length] = rank.get(length, 0) + m * times
            offset += m * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Columns of ``pieces`` plus ``sequence_id`` and ``offset``; ``length`` is at most ``capacity``.

    Sequences hold at most ``capacity`` tokens, without gaps from 0, and are as few as the
    patterns allow. Rows are told apart by where they are stored, so repeated rows are
    pieces of their own. An empty table gives an empty table.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    stored = materialize(pieces.select(*[F.col(f"`{c}`") for c in names]), "pieces", row_id="__row")
    part = F.shiftright("__row", 33).alias("__part")
    held = stored.select("__row", part, "length").groupBy("__part", "length").agg(F.count(F.lit(1)).alias("n"))
    held = materialize(held, "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in held.groupBy("length").agg(F.sum("n").alias("n")).collect():  # <= capacity rows
        counts[length] = n
    table = slots(plan_patterns(counts, capacity))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("__part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__part", "length").orderBy("__row")
    ranked = stored.select("__row", part, "length").withColumn("__rank", F.row_number().over(inside) - 1)
    ranked = ranked.join(offsets, ["__part", "length"]).select(
        "__row", "length", (F.col("__rank") + F.col("__before")).alias("rank")
    )
    width = np.int64(1) << np.int64(48)
    key = table[:, 0] * width + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            _, first, m, sequence, offset = table[np.searchsorted(key, length * width + rank, "right") - 1].T
            at = rank - first
            arrays = [batch.column("__row"), pa.array(sequence + at // m), pa.array(offset + at % m * length)]
            yield pa.RecordBatch.from_arrays(arrays, names=["__row", "sequence_id", "offset"])

    placed = ranked.mapInArrow(place, "__row long, sequence_id long, offset long")
    return stored.join(placed, "__row").select(*[F.col(f"`{c}`") for c in names], "sequence_id", "offset")


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    ranks: str | None = None,
    end_id: int = 0,
    keep_ids: bool = True,
) -> DataFrame:
    """Every document, tokenised and closed by ``end_id``, as pieces placed in sequences.

    Columns: the id, piece, start, length, ids_crc32, ids (if wanted), sequence_id, offset.
    Only documents over ``capacity`` tokens are cut. A NULL text is an empty one, which is
    the closing token alone. NULL and repeated ids pass through, a row being a document.
    Other columns are not read. An empty table gives an empty table.
    """
    pieces = tokenize(docs, id_col, text_col, capacity, vocabulary, ranks, end_id, keep_ids)
    return pack(pieces, capacity)
