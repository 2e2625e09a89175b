"""Words grouped with their spelling variants, one inserted, deleted or replaced letter apart.

Candidates come from bidirectional FM-indexes over the vocabulary, every word between two
delimiters. An error in one half of a word leaves the other exact, so there are two searches: match the left half
exactly from the middle out to the delimiter, then extend to the right over the other half
with one error and to the closing delimiter; and the same from the right. Both keep a range of suffix ranks in
the index of the text and the matching range in that of the reversed text, so a pattern grows at
either end. A range that ends up between delimiters is one word.

**Distribution**: a word that shares a half with another shares the ends of that half. So every
word is indexed by a key from its beginning and by one from its end: its length and as many
letters as any word one error away must share if that half is exact. A word looks under the keys of its own
length and of those one shorter and one longer, for one kind of error each. Keys are dealt by hash to indexes of
bounded size. A key with more words than an index takes is cut into several, and those that look under it visit
each of these. What a word has near it is bounded by its length and the alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import batches_of, materialize

#: Fixed values of the task: what a word needs, how runs are damaged, what a form outnumbers.
LEAST_LETTERS, LEAST_COUNT = 6, 5
DAMAGED = 199
RATIO = 5
#: Letters are those of Latin-1; in it, every other sign of a text becomes a question mark.
RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LETTERS)
CHUNK_BYTES = 4 << 20
REMEMBERED = 1 << 17
#: Words of an index on average, and of a key at most.
INDEX_WORDS = 4096
SIDES = ("left", "right")
#: Kinds of errors by the length they lead to, less that of the word.
DELETED, REPLACED, INSERTED = -1, 0, 1
WINDOW = 32
END, DELIMITER, FIRST = 0, 1, 2


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: every word of at least six letters, five occurrences or more, in whole texts.

    A run of letters counts in lower case (A-Z only). One whose CRC-32 with its document's id is
    divisible by 199 loses the letter that the CRC-32 names. NULL texts have no words and a NULL id
    counts as an empty one; equal rows count each. Words are counted per task before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in batches_of(batches, "__text", CHUNK_BYTES):
            ids = batch.column("__id").to_pylist()
            for doc, text in zip(ids, batch.column("__text").to_pylist(), strict=True):
                if not text:
                    continue
                runs = Counter(RUN.findall(text.encode("latin-1", "replace").lower()))
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in runs.items():
                    whole = word if word.isascii() else word.decode("latin-1").encode("utf-8")
                    h = zlib.crc32(whole, start)
                    if h % DAMAGED == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST_LETTERS:
                            continue
                    total[word] += n
            if len(total) > REMEMBERED:
                yield flush()
                total.clear()
        if total:
            yield flush()

    plain = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("__id"), F.col(f"`{text_col}`").alias("__text")
    )
    counted = plain.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def shared(length: Column) -> Column:
    """Letters that a word of this length shares with any one error away in its other half."""
    return F.greatest(F.lit(LEAST_LETTERS // 2), F.floor((length - 1) / 2)).cast("int")


def _key(side: str, length: Column) -> list[Column]:
    """The key a word of ``length`` is found by, taken from ``word``."""
    n = shared(length)
    ends = F.substring("word", F.lit(1), n) if side == "left" else F.right(F.col("word"), n)
    return [F.lit(side).alias("side"), length.cast("int").alias("length"), ends.alias("ends")]


def near_words(vocabulary: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """Per word with any: ``n_near`` near words and ``best``, that of largest n (n, form).

    ``vocabulary``: distinct ``word`` of at least six letters, and ``n``.
    """
    words = materialize(vocabulary.select("word", "n"), "vocabulary")
    length = F.length("word")
    indexed = words.select("word", "n", F.explode(F.array(*[F.struct(*_key(s, length)) for s in SIDES])).alias("key"))
    kinds = [
        F.struct(*_key(s, length + kind), F.lit(kind).alias("kind"))
        for s in SIDES
        for kind in (DELETED, REPLACED, INSERTED)
    ]
    asked = words.select("word", F.explode(F.array(*kinds)).alias("key")).filter(
        F.col("key.length") >= LEAST_LETTERS
    )
    names = ["side", "length", "ends"]
    indexed = indexed.select("word", "n", *[F.col(f"key.{c}") for c in names])
    asked = asked.select("word", *[F.col(f"key.{c}") for c in names], F.col("key.kind"))
    # Keys with more words than an index takes, counted map-side, are cut into pieces.
    sizes = materialize(indexed.groupBy(*names).agg(F.count(F.lit(1)).alias("size")), "sizes")
    oversize = sizes.filter(F.col("size") > index_words).select(
        *names, F.ceil(F.col("size") / index_words).cast("int").alias("pieces")
    )
    total = sizes.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-2 * total // index_words))
    pieces = F.coalesce("pieces", F.lit(1))
    place = F.pmod(F.xxhash64(*names, "piece"), F.lit(parts)).cast("int").alias("part")
    held = indexed.join(oversize, names, "left").withColumn("piece", F.pmod(F.xxhash64("word"), pieces))
    # A key that no other word has is not looked under.
    seen = sizes.select(*names)
    visits = (
        asked.join(seen, names)
        .join(oversize, names, "left")
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), (pieces - 1).cast("long"))))
    )
    # Both come from the same words; toDF makes their columns distinct.
    held = held.select(place, "side", "word", "n").toDF("part", "side", "word", "n")
    visits = visits.select(place, "side", "word", "kind").toDF("part", "side", "word", "kind")

    def search(_, visits: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        for side in SIDES:
            known = held[held["side"] == side].drop_duplicates("word").sort_values("word")
            if known.empty:
                continue
            index = WordIndex(known["word"].tolist())
            counts = known["n"].to_numpy()
            for kind in (DELETED, REPLACED, INSERTED):
                mine = visits[(visits["side"] == side) & (visits["kind"] == kind)]["word"].drop_duplicates().tolist()
                for at, word in zip(*index.one_error(mine, side, kind), strict=True):
                    asked, form = mine[at], index.words[word]
                    # What both halves lead to counts on the left only.
                    if side == "left" or not form.startswith(asked[: len(asked) // 2]):
                        found.append((asked, form, int(counts[word])))
        near: Counter[str] = Counter()
        best: dict[str, tuple[int, str]] = {}
        for word, form, n in found:
            near[word] += 1
            best[word] = min(best.get(word, (-n, form)), (-n, form))
        rows = [(word, near[word], form, -less) for word, (less, form) in best.items()]
        return pd.DataFrame(rows, columns=["word", "n_near", "form", "form_n"])

    found = (
        visits.groupBy("part").cogroup(held.groupBy("part"))
        .applyInPandas(search, "word string, n_near long, form string, form_n long")
    )
    # Largest n first, then the smallest in code points: what min makes of the pair.
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form"))).alias("best"),
    )


def group_spellings(vocabulary: DataFrame, ratio: int = RATIO, index_words: int = INDEX_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of a vocabulary (``word, n``).

    The form is the near word of largest n, ties to the smallest in code points, if it occurs
    ``ratio`` times as often; the root follows forms to the last. An empty vocabulary gives no rows.
    """
    words = materialize(vocabulary, "words")
    near = near_words(words, index_words)
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"),
    )
    judged = materialize(
        judged.select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")), "forms"
    )
    roots = follow(judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def follow(links: DataFrame) -> DataFrame:
    """``word, root``: links (one per word, without circles) followed to their end.

    Every round joins the pointers with themselves, which doubles what they span. A form occurs
    several times as often as its word, so their number is a logarithm of the largest count.
    """
    now = materialize(links, "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        joined = now.join(further, "root", "left")
        now = materialize(
            joined.select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("__moved")), "roots"
        )
        if now.filter("__moved").isEmpty():
            return now.drop("__moved")
        now = now.drop("__moved")


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` in order; its last symbol occurs nowhere else and is the smallest.

    Eight symbols at once settle most; groups still alike are sorted by the rank of what follows.
    """
    n, width = text.size, 8
    padded = np.append(text, np.zeros(width, np.uint8)).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(width):
        key = key << np.uint64(8) | padded[i : n + i]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    first = np.ones(n, bool)
    first[1:] = key[order][1:] != key[order][:-1]
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while not first.all():
        # Places in the order whose group has more than one suffix.
        open_ = np.flatnonzero(~(first & np.append(first[1:], True)))
        at = order[open_]
        behind = np.where(at + width < n, rank[np.minimum(at + width, n - 1)], -1)
        by = np.lexsort((behind, rank[at]))
        at, behind, group = at[by], behind[by], rank[at[by]]
        order[open_] = at
        new = np.ones(at.size, bool)
        new[1:] = (group[1:] != group[:-1]) | (behind[1:] != behind[:-1])
        first[open_] = new
        rank[at] = np.maximum.accumulate(np.where(new, open_, 0))
        width *= 2
    return order


class Transform:
    """Symbols before the sorted suffixes, with how many below a symbol stand before a place."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.order = suffix_order(text)
        self.before = text[self.order - 1]
        n = text.size
        blocks = n // WINDOW + 1
        counts = np.zeros((blocks + 1, symbols + 1), np.int32)
        np.add.at(counts, (np.arange(n) // WINDOW + 1, self.before + 1), 1)
        self.below = counts.cumsum(axis=0, dtype=np.int32).cumsum(axis=1, dtype=np.int32)
        self.padded = np.append(self.before, np.full(2 * WINDOW, 255, np.uint8))
        self.starts = np.zeros(symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.starts[1:])

    def fewer(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Symbols below ``symbol`` before ``place``."""
        block = place // WINDOW
        window = self.padded[(block * WINDOW)[:, None] + np.arange(WINDOW)]
        inside = np.arange(WINDOW) < (place % WINDOW)[:, None]
        return self.below[block, symbol] + ((window < symbol[:, None]) & inside).sum(axis=1)


class WordIndex:
    """A bidirectional index over words, sorted and between delimiters.

    A range is ``low`` of the text's index, ``other`` of the reversed text's, and their common size.
    """

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        raw = np.frombuffer(("\x01" + "\x01".join(self.words) + "\x01").encode("latin-1"), np.uint8)
        letters = np.unique(raw[raw != DELIMITER])
        self.code = np.zeros(256, np.int64)
        self.code[letters] = np.arange(letters.size) + FIRST
        self.code[DELIMITER] = DELIMITER
        self.letters = letters.size
        text = self.code[raw].astype(np.uint8)
        symbols = self.letters + FIRST
        self.forward = Transform(np.append(text, np.uint8(END)), symbols)
        self.backward = Transform(np.append(text[::-1], np.uint8(END)), symbols)
        # The delimiters' suffixes in order: the one that closes the text, then by the word behind.
        self.word_at = np.cumsum(text == DELIMITER)

    def whole(self, n: int) -> np.ndarray:
        """``n`` ranges of the empty pattern: low, other, size."""
        return np.tile(np.array([[0], [0], [self.word_at.size + 1]]), (1, n))

    def extend(self, ranges: np.ndarray, symbol: np.ndarray, left: bool) -> np.ndarray:
        """Ranges after one more symbol at the left or right end; a size of 0 is no match."""
        low, other, size = ranges if left else ranges[[1, 0, 2]]
        index = self.forward if left else self.backward
        below = index.fewer(symbol, low)
        below_end = index.fewer(symbol, low + size)
        upto = index.fewer(symbol + 1, low)
        upto_end = index.fewer(symbol + 1, low + size)
        start = index.starts[symbol] + upto - below
        moved = np.stack([start, other + below_end - below, (upto_end - below_end) - (upto - below)])
        # A letter the vocabulary lacks has code 0 and matches nothing.
        moved[2, symbol == END] = 0
        return moved if left else moved[[1, 0, 2]]

    def one_error(self, words: list[str], side: str, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``words``, word of the index) one error of ``kind`` apart, the half at ``side`` exact."""
        found_at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for rows in by_length.values():
            rows = np.array(rows)
            raw = "".join([words[i] for i in rows]).encode("latin-1")
            codes = self.code[np.frombuffer(raw, np.uint8).reshape(rows.size, -1)]
            at, word = self._scheme(codes, side == "left", kind)
            found_at.append(rows[at])
            found.append(word)
        return np.concatenate(found_at), np.concatenate(found)

    def _scheme(self, codes: np.ndarray, left: bool, kind: int) -> tuple[np.ndarray, np.ndarray]:
        n, length = codes.shape
        half = length // 2
        delimiter = np.full(n, DELIMITER)
        ranges, alive = self.whole(n), np.arange(n)

        def step(ranges, alive, symbols, to_left):
            moved = self.extend(ranges, symbols, to_left)
            live = moved[2] > 0
            return moved[:, live], alive[live]

        # The exact half, from the middle out to its delimiter.
        inner = range(half - 1, -1, -1) if left else range(half, length)
        for i in inner:
            ranges, alive = step(ranges, alive, codes[alive, i], left)
        ranges, alive = step(ranges, alive, delimiter[alive], left)
        # The other half with one error, towards the other delimiter: ranges before it and behind it.
        outer = list(range(half, length) if left else range(half - 1, -1, -1))
        behind, after = ranges[:, :0], alive[:0]
        for i in [*outer, None]:
            fresh, fresh_at = ranges[:, :0], alive[:0]
            if i is None:
                if kind == INSERTED:
                    fresh, fresh_at = self._others(ranges, alive, None, not left)
                behind, after = np.concatenate([behind, fresh], axis=1), np.concatenate([after, fresh_at])
                break
            if kind == INSERTED:
                # A letter more before this one: this one follows it.
                more, more_at = self._others(ranges, alive, None, not left)
                behind, after = np.concatenate([behind, more], axis=1), np.concatenate([after, more_at])
            elif kind == REPLACED:
                fresh, fresh_at = self._others(ranges, alive, codes[alive, i], not left)
            else:
                fresh, fresh_at = ranges, alive
            behind, after = step(behind, after, codes[after, i], not left)
            behind, after = np.concatenate([behind, fresh], axis=1), np.concatenate([after, fresh_at])
            ranges, alive = step(ranges, alive, codes[alive, i], not left)
        behind, after = step(behind, after, delimiter[after], not left)
        # Between two delimiters there is one word, and its rank among them is its number.
        pairs = np.unique(after * (len(self.words) + 1) + behind[0] - self.forward.starts[DELIMITER] - 1)
        return pairs // (len(self.words) + 1), pairs % (len(self.words) + 1)

    def _others(self, ranges: np.ndarray, alive: np.ndarray, without: np.ndarray | None, left: bool):
        """Ranges after each letter that can follow, other than ``without``.

        A range is no wider in letters than in rows: small ranges look at their rows, large ones
        try the alphabet.
        """
        index, low = (self.forward, ranges[0]) if left else (self.backward, ranges[1])
        size = ranges[2]
        few = np.flatnonzero(size <= self.letters)
        many = np.flatnonzero(size > self.letters)
        owner = np.repeat(few, size[few])
        ends = np.cumsum(size[few])
        inside = np.arange(owner.size) - np.repeat(ends - size[few], size[few])
        letter = index.before[low[owner] + inside].astype(np.int64)
        base = self.letters + FIRST
        pairs = np.unique(owner * base + letter)
        every = (many[:, None] * base + np.arange(FIRST, base)[None, :]).reshape(-1)
        pairs = np.concatenate([pairs, every])
        owner, letter = pairs // base, pairs % base
        keep = letter >= FIRST
        if without is not None:
            keep &= letter != without[owner]
        owner, letter = owner[keep], letter[keep]
        moved = self.extend(ranges[:, owner], letter, left)
        live = moved[2] > 0
        return moved[:, live], alive[owner[live]]
