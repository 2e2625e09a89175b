"""Benchmark decontamination by an FM-index over each shard of the documents.

A task cuts its documents into shards of bounded size. A shard's words become symbols of
the phrases' own alphabet; a word outside it can be in no occurrence and closes a run, and
runs shorter than every phrase are left out. The shard's index answers all phrases by
backward search, occurrences are located by sampled suffix positions, and their spans
merged. Documents are never shuffled, and nothing of them reaches the driver.

The phrases are the query set: they are sent to the tasks in blocks of at most
``block_bytes`` of item text, each a pass over the documents, so what is sent at once
is bounded whatever the size of the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import ALNUM_WORDS, batches_of, lower_bytes
from starloom.llm.fm_index import FMIndex
from starloom.session import remove_intermediate, scratch_path

SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20
FOUND = "n_words long, item_ids array<string>, spans array<struct<start:long,end:long>>"


@dataclass(frozen=True)
class Phrases:
    """Distinct windows of some items, grouped by length, over an alphabet 1.. of words."""

    alphabet: dict[bytes, int]
    #: Windows, and the items of each: where its ids end, the ids.
    by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    names: list[str]

    @property
    def shortest(self) -> int:
        return min((w.shape[1] for w, _, _ in self.by_length), default=0)


def phrases_of(items: list[tuple[str, str | None]], window: int) -> Phrases:
    """All windows of ``window`` words; an item of fewer words is one window itself."""
    alphabet: dict[bytes, int] = {}
    names = sorted({name for name, _ in items})
    number = {name: i for i, name in enumerate(names)}
    held: dict[int, dict[tuple[int, ...], set[int]]] = {}
    for name, text in items:
        found = ALNUM_WORDS.findall(lower_bytes(text))
        words = [alphabet.setdefault(w, len(alphabet) + 1) for w in found]
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            owners = held.setdefault(size, {}).setdefault(tuple(words[at : at + size]), set())
            owners.add(number[name])
    grouped = []
    for size in sorted(held):
        windows = np.array(list(held[size]), np.int64).reshape(-1, size)
        ends = np.cumsum([len(x) for x in held[size].values()])
        ids = np.array([i for x in held[size].values() for i in sorted(x)], np.int64)
        grouped.append((windows, ends, ids))
    return Phrases(alphabet, grouped, names)


def _compact(symbols: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of at least ``shortest`` known words, each closed by one 0, and where they were."""
    known = np.concatenate([[False], symbols > 0, [False]])
    edges = np.flatnonzero(known[1:] != known[:-1]).reshape(-1, 2)
    edges = edges[edges[:, 1] - edges[:, 0] >= shortest]
    if not edges.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = edges[:, 1] - edges[:, 0] + 1  # with the closing 0
    ends = np.cumsum(sizes)
    places = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(edges[:, 0], sizes)
    text = symbols[np.minimum(places, symbols.size - 1)].copy()
    text[ends - 1] = 0
    return text, places


def scan_shard(
    texts: list[str | None], phrases: Phrases
) -> list[tuple[int, list[str], list[tuple[int, int]]]]:
    """Per text: number of words, names of the items found, merged spans of words [start, end)."""
    get = phrases.alphabet.get
    per_text = []
    for text in texts:
        words = ALNUM_WORDS.findall(lower_bytes(text))
        per_text.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
    counts = np.array([x.size for x in per_text], np.int64)
    gap = [np.zeros(1, np.int64)]
    symbols = np.concatenate([x for one in per_text for x in (one, gap[0])] or gap)
    starts = np.cumsum(counts + 1) - counts - 1
    found: list[tuple[set[int], list[tuple[int, int]]]] = [(set(), []) for _ in texts]
    text, places = _compact(symbols, max(1, phrases.shortest))
    if text.size and phrases.by_length:
        index = FMIndex(text, len(phrases.alphabet))
        spans, hits = [], []
        for windows, ends, ids in phrases.by_length:
            low, high = index.search(windows)
            live = np.flatnonzero(low < high)
            if not live.size:
                continue
            size = (high - low)[live]
            first = np.cumsum(size) - size
            rows = np.arange(size.sum()) - np.repeat(first, size) + np.repeat(low[live], size)
            at = places[index.locate(rows)]
            spans.append(np.stack([at, at + windows.shape[1]], axis=1))
            doc = np.searchsorted(starts, at, side="right") - 1
            pairs = np.unique(np.stack([np.repeat(live, size), doc], axis=1), axis=0)
            begin = np.where(pairs[:, 0] > 0, ends[pairs[:, 0] - 1], 0)
            many = ends[pairs[:, 0]] - begin
            offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            items = ids[np.repeat(begin, many) + offset]
            hits.append(np.unique(np.stack([np.repeat(pairs[:, 1], many), items], axis=1), axis=0))
        if spans:
            for doc, item in np.concatenate(hits).tolist():
                found[doc][0].add(item)
            every = np.concatenate(spans)
            every = every[np.argsort(every[:, 0], kind="stable")]
            reach = np.maximum.accumulate(every[:, 1])
            opens = np.ones(len(every), bool)
            opens[1:] = every[1:, 0] > reach[:-1]
            closes = np.append(np.flatnonzero(opens)[1:] - 1, len(every) - 1)
            begin, end = every[opens, 0], reach[closes]
            owner = np.searchsorted(starts, begin, side="right") - 1
            for doc, a, b in zip(owner.tolist(), begin.tolist(), end.tolist(), strict=True):
                found[doc][1].append((a - int(starts[doc]), b - int(starts[doc])))
    return [
        (int(n), sorted(phrases.names[i] for i in items), spans)
        for n, (items, spans) in zip(counts.tolist(), found, strict=True)
    ]


def _blocks(items: DataFrame, item_col: str, text_col: str, size: int) -> Iterator[tuple[list, bool]]:
    """Items streamed to the driver in blocks of bounded size, and whether a block is the last one."""
    block, held = [], 0
    named = items.filter(F.col(f"`{item_col}`").isNotNull())
    for name, text in named.select(
        F.col(f"`{item_col}`").cast("string"), F.col(f"`{text_col}`")
    ).toLocalIterator():
        n = len(text or "")
        if block and held + n > size:
            yield block, False
            block, held = [], 0
        block.append((name, text))
        held += n
    yield block, True


def _united(items: list[str], spans: list[tuple[int, int]], more: dict) -> tuple[list[str], list[tuple[int, int]]]:
    """What a document had so far together with what another block found in it."""
    merged: list[tuple[int, int]] = []
    for a, b in sorted([*spans, *((s["start"], s["end"]) for s in more["spans"])]):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return sorted({*items, *more["item_ids"]}), merged


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Columns of ``docs`` plus n_words, item_ids, spans, n_hit, n_items and contaminated.

    ``item_ids``: items of which a window of ``window`` words occurs, as sorted strings.
    ``spans``: merged ranges of words to remove, ends exclusive. ``n_hit``: words in them.

    A NULL or empty text has no words; an item without words has no window and matches
    nothing, nor does one without an id. Items that repeat count once. Rows of ``docs``
    are judged one by one, whatever their ids. Columns of ``docs`` with the names of the results are
    replaced, others pass through, whatever their type. Empty tables are fine on either side.

    Items beyond ``block_bytes`` come in several blocks. The driver and the tasks hold one at a time;
    rows with what was found so far are stored between blocks and never shuffled.
    """
    added = {"n_words", "item_ids", "spans", "n_hit", "n_items", "contaminated"}
    names = [c for c in docs.columns if c not in added]
    plain = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType(plain.schema.fields + T.StructType.fromDDL(FOUND).fields)
    arrow = pa.schema(
        [
            ("n_words", pa.int64()),
            ("item_ids", pa.list_(pa.string())),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
    )

    def passes(block: list, rows: DataFrame, first: bool) -> DataFrame:
        phrases = phrases_of(block, window)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches_of(batches, text_col, shard_bytes):
                found = scan_shard(batch.column(text_col).to_pylist(), phrases)
                if not first:
                    so_far = batch.select(["item_ids", "spans"]).to_pylist()
                    found = [(n, *_united(x, y, z)) for (n, x, y), z in zip(found, so_far, strict=True)]
                columns = [
                    pa.array([r[0] for r in found], arrow.field(0).type),
                    pa.array([r[1] for r in found], arrow.field(1).type),
                    pa.array(
                        [[{"start": a, "end": b} for a, b in r[2]] for r in found], arrow.field(2).type
                    ),
                ]
                kept = batch.columns[: len(names)]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*names, *arrow.names])

        return rows.mapInArrow(scan, schema)

    found, first, path = plain, True, None
    for block, last in _blocks(items, item_col, item_text_col, block_bytes):
        found = passes(block, found, first)
        if not last:
            before, path = path, scratch_path(docs.sparkSession, "decontaminated")
            found.write.parquet(path)
            found = docs.sparkSession.read.schema(schema).parquet(path)
            if before:
                remove_intermediate(docs.sparkSession, before)
        first = False
    spans = F.col("spans")
    return (
        found.withColumn(
            "n_hit",
            F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]),
        )
        .withColumn("n_items", F.size("item_ids").cast("long"))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )
