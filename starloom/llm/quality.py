"""Quality rules: fixed counts, and logistic regressions on hashed n-grams of words and bytes.

One regression is trained on the quality label and one on the toxicity label of labelled
documents, each calibrated on labelled rows it did not see. Training takes a bounded sample
in one task; every count and every score covers whole texts, in Arrow batches. What is
sent to the scoring tasks are two weight vectors of fixed size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import batches_of, lower_bytes

MAX_TRAIN = 4_000
BUCKETS = 1 << 17
#: Rows whose features a step of the descent works on at a time.
BLOCK_ROWS = 128
CHARS = (3, 5)
#: A word tells toxicity if so many documents of the sample have it.
MIN_SEEN = 10
WORDS = 100_000
CHUNK_BYTES = 4 << 20
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A document goes when it is good with less, or toxic with more than this probability.
MIN_GOOD, MAX_TOXIC = 0.5, 0.5
SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_CONTINUATION = bytes(range(0x80, 0xC0))


class Reader:
    """Counts and hashed features of one text."""

    def __init__(self):
        self.hashes: dict[bytes, int] = {}

    def _word(self, word: bytes) -> int:
        found = self.hashes.get(word)
        if found is None:
            if len(self.hashes) >= WORDS:
                self.hashes.clear()
            found = self.hashes[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def counts(self, text: str | None) -> tuple[int, int, int, int, int]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()
        points = len(raw.translate(None, SPACES + _CONTINUATION))
        symbols = len(raw) - len(raw.translate(None, SYMBOLS))
        lines = [line for line in raw.split(b"\n") if not line.isspace() and line]
        return len(words), points, symbols, len(lines) - len(set(lines)), self._repeated(words)

    def _repeated(self, words: list[bytes]) -> int:
        """Words inside windows of three that the text has at least twice."""
        n = len(words)
        if n < 4:
            return 0
        h = np.fromiter(map(self._word, words), np.uint64, n)
        odd = np.uint64(0x9E3779B97F4A7C15)
        window = ((h[:-2] * odd ^ h[1:-1]) * odd ^ h[2:]) * odd
        ordered = np.sort(window)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not twice.size:
            return 0
        at = np.searchsorted(twice, window)
        hit = twice[np.minimum(at, twice.size - 1)] == window
        covered = np.zeros(n, bool)
        for i in range(3):
            covered[i : n - 2 + i] |= hit
        return int(covered.sum())

    def words(self, text: str | None) -> np.ndarray:
        """Buckets of the lower-cased words, and of pairs, in the second half."""
        found = re.findall(rb"[a-z\x80-\xff]+", lower_bytes(text))
        h = np.fromiter(map(self._word, found), np.uint64, len(found))
        odd = np.uint64(0x9E3779B97F4A7C15)
        pairs = (h[:-1] * odd ^ h[1:]) * odd
        half = np.uint64(BUCKETS // 2)
        return np.concatenate([h % half, (pairs >> np.uint64(20)) % half + half]).astype(np.int64)

    def chars(self, text: str | None) -> np.ndarray:
        """Buckets of the byte n-grams of the text as it is, case and symbols included."""
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
        found = []
        for n in CHARS:
            if raw.size >= n:
                h = np.zeros(raw.size - n + 1, np.uint32)
                for i in range(n):
                    h = h * np.uint32(0x01000193) ^ raw[i : raw.size - n + 1 + i]
                h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                found.append(h >> np.uint32(32 - (BUCKETS.bit_length() - 1)))
        return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Model:
    """Weights for word and byte n-grams, and the calibration a * score + b."""

    words: np.ndarray
    chars: np.ndarray
    a: float
    b: float

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * score + self.b, -30, 30)))


def _stack(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (buckets, values) one after the other: where they end, buckets, values."""
    none = np.zeros(0, np.int32), np.zeros(0, np.float32)
    ends = np.cumsum([at.size for at, _ in rows], dtype=np.int64)
    return ends, *(np.concatenate([r[i] for r in rows] or [none[i]]) for i in (0, 1))


def _shares(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share that each has of all."""
    at, n = np.unique(buckets.astype(np.int32), return_counts=True)
    return at, (n / max(1, n.sum())).astype(np.float32)


def _row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])]


def _descend(blocks, y: np.ndarray, weight: np.ndarray, epochs: int, rate: float, sparse: float):
    """Weighted logistic loss over blocks of rows, each with its parts (ends, buckets, values), by
    proximal Adam. Only one block at a time takes floats of double size.

    One weight vector a part, and the bias last. ``sparse`` is the l1 penalty of a weight.
    """
    parts = len(blocks[0])
    w = [np.zeros(BUCKETS) for _ in range(parts)] + [np.zeros(1)]
    m, v = [x.copy() for x in w], [x.copy() for x in w]
    weight = weight / weight.sum()
    for epoch in range(1, epochs + 1):
        grads, start = [np.zeros_like(x) for x in w], 0
        for block in blocks:
            score = _block_score(block, w)
            rows = slice(start, start + score.size)
            start += score.size
            off = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y[rows]) * weight[rows]
            for grad, (ends, at, x) in zip(grads, block, strict=False):
                grad += np.bincount(at, np.repeat(off, np.diff(ends, prepend=0)) * x, BUCKETS)
            grads[-1] += off.sum()
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            step = rate / (np.sqrt(v[i] / (1 - 0.99**epoch)) + 1e-7)
            moved = w[i] - step * m[i] / (1 - 0.9**epoch)
            w[i] = np.sign(moved) * np.maximum(0, np.abs(moved) - step * sparse * (i < parts))
    return w


def _calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid by Newton steps, with smoothed targets."""
    up, down = y.sum(), y.size - y.sum()
    if not up or not down:
        return 1.0, 0.0
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    middle, spread = score.mean(), score.std() + 1e-12  # else a sure score has no slope
    x = np.stack([(score - middle) / spread, np.ones_like(score)], axis=1)
    ab = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        ab = ab - np.clip(np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (ab - [1, 0])), -2, 2)
    slope = max(ab[0], 1e-3) / spread
    return float(slope), float(ab[1] - slope * middle)


def _block_score(block, w: list[np.ndarray]) -> np.ndarray:
    score = np.full(block[0][0].size, w[-1][0])
    for (ends, at, x), one in zip(block, w, strict=False):
        score = score + _row_sums(one[at] * x, ends)
    return score


def _score(blocks, w: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([_block_score(block, w) for block in blocks])


def train_models(texts: list[str | None], good: np.ndarray, toxic: np.ndarray) -> tuple[Model, Model]:
    """Quality on shares of byte and word n-grams, toxicity on the presence of words and pairs.

    Where the labels do not differ, the usual answer stands: good, not toxic. Every fifth row
    is held out of the descent and calibrates the score. Features are kept once, in blocks of
    ``BLOCK_ROWS`` rows; both models go through them block by block.
    """
    reader = Reader()
    held = np.arange(len(texts)) % 5 == 4
    models = []
    fit, rest = np.flatnonzero(~held), np.flatnonzero(held)

    def shares(rows):
        blocks = [rows[i : i + BLOCK_ROWS] for i in range(0, rows.size, BLOCK_ROWS)]
        return [
            [_stack([_shares(read(texts[i])) for i in block]) for read in (reader.words, reader.chars)]
            for block in blocks
        ]

    fit_blocks, rest_blocks = shares(fit), shares(rest)
    seen = np.zeros(BUCKETS, np.int64)
    for (_, at, _), _ in fit_blocks:
        seen += np.bincount(at, minlength=BUCKETS)

    def presence(blocks):
        for (ends, at, _), _ in blocks:
            often = seen[at] >= MIN_SEEN
            kept = np.concatenate([[0], np.cumsum(often)])[ends]
            yield [(kept, at[often], np.ones(int(kept[-1]), np.float32))]

    none = np.zeros(BUCKETS)
    for y, parts, settings, usual in (
        (good, list, (60, 1.0, 0.0), 5.0),
        (toxic, lambda blocks: list(presence(blocks)), (200, 0.1, 1e-4), -5.0),
    ):
        w, a, b = [none, none, np.zeros(1)], 1.0, usual
        if fit.size and 0 < y[fit].sum() < fit.size:
            yes = y[fit].mean()
            weight = np.where(y[fit] > 0, 0.5 / yes, 0.5 / (1 - yes))
            w = _descend(parts(fit_blocks), y[fit].astype(float), weight, *settings)
            if rest.size:
                a, b = _calibrate(_score(parts(rest_blocks), w), y[rest].astype(float))
            else:
                b = 0.0
        two = w[1] if len(w) == 3 else none
        bias = b + a * float(w[-1][0])
        models.append(Model(w[0].astype(np.float32), two.astype(np.float32), a, bias))
    return models[0], models[1]


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    max_train: int = MAX_TRAIN,
) -> tuple[Model, Model]:
    """Both models, from at most ``max_train`` labelled documents, chosen by a hash of their id.

    Labels that are NULL or point to no document are left out. The sample is trained on in
    one task; only the weights return.
    """
    known = labels.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col("quality").cast("int").alias("q"),
        F.col("toxic").cast("int").alias("t"),
    )
    known = known.dropna().dropDuplicates(["id"])
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_train)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = chosen.join(texts, "id")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable").drop_duplicates("id")
        models = train_models(frame["text"].tolist(), frame["q"].to_numpy(), frame["t"].to_numpy())
        return pd.DataFrame(
            [(i, m.words.tobytes(), m.chars.tobytes(), m.a, m.b) for i, m in enumerate(models)],
            columns=["model", "words", "chars", "a", "b"],
        )

    schema = "model int, words binary, chars binary, a double, b double"
    def weights(blob: bytes) -> np.ndarray:
        return np.frombuffer(blob, np.float32)

    trained = rows.withColumn("g", F.lit(1)).groupBy("g").applyInPandas(run, schema)
    got = {  # two rows
        r["model"]: Model(weights(r["words"]), weights(r["chars"]), r["a"], r["b"])
        for r in trained.collect()
    }
    none = np.zeros(BUCKETS, np.float32)
    return got.get(0, Model(none, none, 1.0, 5.0)), got.get(1, Model(none, none, 1.0, -5.0))


def judge(
    docs: DataFrame,
    models: tuple[Model, Model],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_good: float = MIN_GOOD,
    max_toxic: float = MAX_TOXIC,
) -> DataFrame:
    """Columns of ``docs`` plus the counts, base_failed, p_good, p_toxic and kept.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows.
    ``kept``: passes the base, good with at least ``min_good`` and toxic with at most
    ``max_toxic`` probability.

    A NULL, empty or blank text has no words and fails the base. Rows are judged one by
    one, so repeated rows and ids get equal verdicts and NULL ids pass through. Columns of ``docs``
    named as the results are replaced. Without labels, only the base decides. An empty
    table gives an empty table.
    """
    added = {*COUNTS, "base_failed", "p_good", "p_toxic", "kept"}
    plain = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    ddl = ", ".join(f"{c} long" for c in COUNTS) + ", p_good double, p_toxic double"
    schema = T.StructType(plain.schema.fields + T.StructType.fromDDL(ddl).fields)
    good, bad = models

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches_of(batches, text_col, CHUNK_BYTES):
            counts, p_good, p_toxic = [], [], []
            for text in batch.column(text_col).to_pylist():
                counts.append(reader.counts(text))
                words, chars = reader.words(text), reader.chars(text)
                p_good.append(
                    sum(
                        w.take(at).mean(dtype=float)
                        for w, at in ((good.words, words), (good.chars, chars))
                        if at.size
                    )
                )
                p_toxic.append(bad.words.take(np.unique(words)).sum(dtype=float))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(COUNTS))]
            for model, scores in ((good, p_good), (bad, p_toxic)):
                columns.append(pa.array(model.probability(np.array(scores, float))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, *COUNTS, "p_good", "p_toxic"]
            )

    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    failed = (F.col("n_words") < MIN_WORDS) | repeats
    fine = (F.col("p_good") >= min_good) & (F.col("p_toxic") <= max_toxic)
    judged = plain.mapInArrow(run, schema).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & fine)


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Train on the labelled documents and judge all of them, see ``train`` and ``judge``."""
    return judge(docs, train(docs, labels, id_col, text_col), id_col, text_col)
