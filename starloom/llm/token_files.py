"""Token ids of documents in binary files, and a minimal perfect hash index over them.

A file holds the raw ids of consecutive documents, two bytes each where the vocabulary allows
it, and ends with a footer: an Arrow table of the documents' keys and lengths, its size and a mark.
Files are written by Spark's own writer from a range-partitioned sort, so a lost task
is run again and never leaves half a file behind.

The index maps a key to file, offset and length in constant time. Keys are dealt by hash to
buckets of bounded size. In a bucket each level is a bit vector: keys that alone hash to a bit
are settled there, the others go on to the next level. The rank of a key's bit, over all
levels, is its slot, and the slots are exactly 0..n-1. A slot holds no key, only 32 bits of
another hash of it, by which absent keys are told from present ones (one in 2^32 is not).
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import batches_of, materialize
from starloom.llm.fm_index import Bits

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
CHUNK_BYTES = 1 << 20
#: Chunks of ids in a file; the footer is its last record.
CHUNKS = 15
MARK = b"ids16\x00\x01\x00"
#: Keys in a bucket of the index on average, and bits for each key still unsettled.
BUCKET = 8192
SPARE = 1.5
REMEMBERED = 1 << 18
#: What the vocabulary's splitter takes as one piece, for texts of PLAIN signs.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+|\n")
PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
SPACES = re.compile("[ \t\n\r]+")


def byte_of_sign() -> dict[str, int]:
    """The signs by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordEncoder:
    """Ids of texts by a vocabulary with word ends, as little-endian unsigned 16-bit numbers.

    ``tokenizers`` defines the ids. White space separates pieces and is dropped, so each run of other
    signs is encoded once and remembered, up to a bound. Texts of plain Latin letters
    take the same merges through ``tiktoken``, the word's end written as a zero byte; the others, and
    those that hold a special token, ``tokenizers`` itself.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        code, ranks = byte_of_sign(), {}
        known = self.exact.get_vocab(with_added_tokens=False)
        if max(known.values()) >= 1 << 16:
            raise ValueError("ids take 16 bits here")
        for token, number in known.items():
            if token not in self.special:
                core, end = token.removesuffix("</w>"), token.endswith("</w>")
                ranks[bytes(code[c] for c in core) + b"\0" * end] = number
        self.fast = tiktoken.Encoding(
            "words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}
        )
        self.line = ranks[b"\n\0"]
        self.memo: dict[str, bytes] = {"": b""}

    def _exact(self, run: str) -> bytes:
        return np.array(self.exact.encode(run, add_special_tokens=False).ids, "<u2").tobytes()

    def _plain(self, runs: list[str]) -> Iterator[bytes]:
        """Ids of each run, all encoded at once with line ends between them, which no run holds."""
        pieces = PIECES.findall("\n".join(runs).lower())
        ids = np.array(self.fast.encode_ordinary("\0".join(pieces) + "\0"), "<u2")
        body, start = ids.tobytes(), 0
        for end in [*np.flatnonzero(ids == self.line).tolist(), ids.size]:
            yield body[2 * start : 2 * end]
            start = end + 1

    def __call__(self, text: str) -> bytes:
        # White space of plain texts is SPACES alone, which is what ``split`` takes them apart by.
        plain = PLAIN.fullmatch(text) is not None
        runs = text.split() if plain else SPACES.split(text)
        if len(self.memo) > REMEMBERED:
            self.memo = {"": b""}
        memo = self.memo
        try:
            return b"".join([memo[run] for run in runs])
        except KeyError:
            missing = [run for run in set(runs) if run not in memo]
        if plain and not any(s in text for s in self.special):
            memo.update(zip(missing, self._plain(missing), strict=True))
        else:
            for run in missing:
                memo[run] = self._exact(run)
        return b"".join([memo[run] for run in runs])


@lru_cache(maxsize=1)
def encoder_of(vocabulary: str) -> WordEncoder:
    """The encoder of a vocabulary, made once in a worker process and used by all of its tasks."""
    return WordEncoder(vocabulary)


def write_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
    chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Encode every text, append ``end_id``, and write files in ascending order of the key.

    NULL texts are empty ones, a NULL key comes first, rows that share a key follow one
    another in an order that depends on their texts only; equal rows stay as often as they are there.
    An empty table gives files without documents. Other columns are not read.

    Documents are range-partitioned by key once, then encoded in order. A file holds at
    most ``CHUNKS`` chunks of about ``chunk_bytes`` each, whatever the size of a partition;
    only a longer document makes a longer chunk.
    """
    end = struct.pack("<H", end_id)
    kind = pa.schema([pa.field("key", _arrow(docs.schema[id_col].dataType)), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(vocabulary or public_tokenizers.path(VOCABULARY))
        part, piece = TaskContext.get().partitionId(), 0
        ids, held, keys, lengths, chunks = [], 0, [], [], 0

        def record(body: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], names=["value"])

        def footer() -> pa.RecordBatch:
            where = {b"part": str(part).encode(), b"piece": str(piece).encode()}
            column = pa.concat_arrays(keys) if keys else pa.array([], kind.field(0).type)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kind.with_metadata(where)) as out:
                out.write_batch(pa.record_batch([column, pa.array(lengths, pa.int64())], kind))
            body = sink.getvalue().to_pybytes()
            return record(body + struct.pack("<q", len(body)) + MARK)

        for batch in batches_of(batches, "__text", 2 * chunk_bytes):
            for row, text in enumerate(batch.column("__text").to_pylist()):
                body = encode(text or "")
                ids.append(body)
                held += len(body) + 2
                lengths.append(len(body) // 2 + 1)
                keys.append(batch.column("__key").slice(row, 1))
                if held >= chunk_bytes:
                    # The writer ends every record with the end id, so the last one needs none.
                    yield record(end.join(ids))
                    ids, held, chunks = [], 0, chunks + 1
                    if chunks == CHUNKS:
                        yield footer()
                        piece, keys, lengths, chunks = piece + 1, [], [], 0
                    elif len(keys) > 4096:
                        keys = [pa.concat_arrays(keys)]
        if ids:
            yield record(end.join(ids))
        if lengths:
            yield footer()

    plain = docs.select(F.col(f"`{id_col}`").alias("__key"), F.col(f"`{text_col}`").alias("__text"))
    # Equal rows part at their position, so that no range has to hold all of them.
    order = ["__key", "__hash", "__at"]
    sorted_docs = (
        plain.withColumns({"__hash": F.xxhash64("__text"), "__at": F.monotonically_increasing_id()})
        .orderBy(*[F.col(c).asc_nulls_first() for c in order])
        .select("__key", "__text")
    )
    (
        sorted_docs.mapInArrow(run, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", end.decode("latin-1"))
        .option("maxRecordsPerFile", CHUNKS + 1)
        .text(path)
    )


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _content(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).filter("length > 0")
    return files.select("content")


def _footer(content: bytes) -> tuple[int, int, pa.Table]:
    """Part and piece of a file, and its documents: keys and lengths."""
    size, mark = struct.unpack("<q8s", content[-18:-2])
    if mark != MARK:
        raise ValueError("not a file of ids")
    table = pa.ipc.open_stream(content[-18 - size : -18]).read_all()
    where = table.schema.metadata
    return int(where[b"part"]), int(where[b"piece"]), table


def _starts(lengths: np.ndarray) -> np.ndarray:
    starts = np.zeros(lengths.size, np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    return starts


def read_documents(spark: SparkSession, path: str, key: T.DataType, digests: bool = True) -> DataFrame:
    """``key, part, piece, at, offset, n_tokens`` of every document in the files, ``at`` its place
    among the file's documents, and the CRC-32 of its ids as unsigned 32-bit numbers.

    Every file is read once, by the task that its block belongs to; its ids are not shuffled.
    """
    extra = ", ids_crc32 long" if digests else ""
    schema = T.StructType(
        [T.StructField("key", key)]
        + T.StructType.fromDDL("part int, piece int, at long, offset long, n_tokens long" + extra).fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                content = content.as_py()
                part, piece, table = _footer(content)
                n = table.column("n").to_numpy()
                offset = _starts(n)
                columns = [
                    table.column("key").combine_chunks(),
                    pa.array(np.full(n.size, part, np.int32)),
                    pa.array(np.full(n.size, piece, np.int32)),
                    pa.array(np.arange(n.size)),
                    pa.array(offset),
                    pa.array(n),
                ]
                if digests:
                    ids = np.frombuffer(content, "<u2", int(n.sum())).astype("<u4").view(np.uint8)
                    ends = (offset + n) * 4
                    columns.append(
                        pa.array([zlib.crc32(ids[a:b]) for a, b in zip(offset * 4, ends, strict=True)], pa.int64())
                    )
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return _content(spark, path).mapInArrow(run, schema)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spot(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
    return (_mix(h1 ^ _mix(h2 + salt)) % np.uint64(size)).astype(np.int64)


def _print(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (_mix(h2 ^ _mix(~h1)) >> np.uint64(32)).astype("<u4")


def perfect_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels and their bits, for keys given as two 64-bit hashes, no two alike."""
    sizes, bits = [], [np.zeros(0, bool)]
    while h1.size:
        if len(sizes) == 200:
            raise ValueError("two keys share both hashes")
        size = max(64, int(h1.size * SPARE))
        spot = _spot(h1, h2, len(sizes), size)
        alone = np.bincount(spot, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = ~alone[spot]
        h1, h2 = h1[left], h2[left]
    return sizes, np.concatenate(bits)


def slots(sizes: list[int], bits: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 for keys that no level settles."""
    ranks, found = Bits(bits), np.full(h1.size, -1, np.int64)
    open_, base = np.arange(h1.size), 0
    for level, size in enumerate(sizes):
        at = base + _spot(h1[open_], h2[open_], level, size)
        here = bits[at]
        found[open_[here]] = ranks.rank(at[here])
        open_, base = open_[~here], base + size
    return found


def _hashes(key: Column, copy: Column) -> list[Column]:
    """Two hashes of a key and its copy; the second one starts from the first."""
    first = F.xxhash64(key, copy)
    return [first.alias("__h1"), F.xxhash64(F.lit(17), first, copy, key).alias("__h2")]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.shiftright("__h1", 8), F.lit(buckets)).cast("int").alias("__bucket")


FIELDS = {"part": "<i4", "piece": "<i4", "offset": "<i8", "start": "<i8", "n_tokens": "<i8"}
INDEX = "bucket int, buckets int, n int, sizes array<int>, bits binary, prints binary, " + ", ".join(
    f"{name} binary" for name in FIELDS
)


def placed_documents(spark: SparkSession, path: str, key: T.DataType) -> DataFrame:
    """All documents of the files with ``start``, the ids of all documents before them, and
    ``copy``, their number among those that share a key.

    Both follow from sums per part, which the driver adds up, and per file within its part.
    """
    found = materialize(read_documents(spark, path, key, digests=False), "footers")
    files = found.groupBy("part", "piece").agg(
        F.sum("n_tokens").alias("ids"), F.count(F.lit(1)).alias("docs")
    )
    parts = files.groupBy("part").agg(F.sum("ids").alias("i"), F.sum("docs").alias("d")).collect()
    before, i, d = [], 0, 0  # one row per partition of the writing job
    for row in sorted(parts, key=lambda r: r["part"]):
        before.append((row["part"], i, d))
        i, d = i + row["i"], d + row["d"]
    base = spark.createDataFrame(before, "part int, __i long, __d long")
    earlier = Window.partitionBy("part").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    files = files.join(F.broadcast(base), "part").select(
        "part",
        "piece",
        (F.col("__i") + F.coalesce(F.sum("ids").over(earlier), F.lit(0))).alias("__i"),
        (F.col("__d") + F.coalesce(F.sum("docs").over(earlier), F.lit(0))).alias("__d"),
    )
    placed = found.join(files, ["part", "piece"]).select(
        *found.columns, (F.col("__i") + F.col("offset")).alias("start"), (F.col("__d") + F.col("at")).alias("__place")
    )
    firsts = placed.groupBy(F.col("key").alias("__key")).agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n"))
    repeated = firsts.filter("__n > 1").drop("__n")
    same = F.col("key").eqNullSafe(F.col("__key"))
    copy = F.coalesce(F.col("__place") - F.col("__first"), F.lit(0)).alias("copy")
    return placed.join(repeated, same, "left").select(*found.columns, "start", copy)


def build_index(placed: DataFrame, path: str, bucket: int = BUCKET) -> None:
    """Write the index over ``placed_documents``: one row per bucket, of bounded size."""
    placed = materialize(
        placed.select(*_hashes(F.col("key"), F.col("copy")), *FIELDS), "keys"
    )
    buckets = max(1, -(-placed.count() // bucket))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (rows[c].to_numpy(np.int64).view(np.uint64) for c in ("__h1", "__h2"))
        sizes, bits = perfect_hash(h1, h2)
        order = np.argsort(slots(sizes, bits, h1, h2))
        packed = {name: rows[name].to_numpy()[order].astype(kind).tobytes() for name, kind in FIELDS.items()}
        return pd.DataFrame(
            [
                {
                    "bucket": rows["__bucket"].iat[0],
                    "buckets": buckets,
                    "n": len(rows),
                    "sizes": sizes,
                    "bits": np.packbits(bits).tobytes(),
                    "prints": _print(h1, h2)[order].tobytes(),
                    **packed,
                }
            ]
        )

    dealt = placed.select("*", _bucket(buckets))
    dealt.groupBy("__bucket").applyInPandas(build, INDEX).write.parquet(path)


def locate(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "key", copy_col: str | None = None) -> DataFrame:
    """``key, copy, part, piece, offset, start, n_tokens`` of those keys that the index holds.

    ``copy_col`` names the copy wanted of a repeated key, else the first one is. Keys that
    are asked for repeatedly are looked up once. Every key meets one bucket, which answers in constant time.
    """
    index = spark.read.schema(INDEX).parquet(path)
    copy = F.col(f"`{copy_col}`").cast("long") if copy_col else F.lit(0).cast("long")
    wanted = keys.select(F.col(f"`{key_col}`").alias("key"), copy.alias("copy")).distinct()
    first = index.select("buckets").first()
    kind = keys.schema[key_col].dataType
    ddl = ", ".join(f"{name} {'int' if code == '<i4' else 'long'}" for name, code in FIELDS.items())
    schema = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL("copy long, " + ddl).fields])
    if first is None:
        return spark.createDataFrame([], schema)
    # Keys stay in the JVM; the tasks see their hashes and a number to find them again.
    asked = materialize(wanted.select("*", *_hashes(F.col("key"), F.col("copy"))), "asked", row_id="__row")

    def look(_, keys: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        names = ["__row", *FIELDS]
        if keys.empty or rows.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in names})
        row = rows.iloc[0]
        sizes = list(row["sizes"])
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
        h1, h2 = (keys[c].to_numpy(np.int64).view(np.uint64) for c in ("__h1", "__h2"))
        slot = slots(sizes, bits, h1, h2)
        known = slot >= 0
        known[known] = np.frombuffer(row["prints"], "<u4")[slot[known]] == _print(h1, h2)[known]
        values = {name: np.frombuffer(row[name], code)[slot[known]] for name, code in FIELDS.items()}
        return pd.DataFrame({"__row": keys["__row"].to_numpy()[known], **values})

    dealt = asked.select("__row", "__h1", "__h2", _bucket(first["buckets"])).groupBy("__bucket")
    side = index.withColumnRenamed("bucket", "__bucket").groupBy("__bucket")
    found = dealt.cogroup(side).applyInPandas(look, "__row long, " + ddl)
    return asked.select("__row", "key", "copy").join(found, "__row").select(*schema.names)


def fetch(spark: SparkSession, path: str, located: DataFrame) -> DataFrame:
    """``key, copy, ids`` of located documents, cut from the files by offset and length.

    Only files with a wanted document take part; what is wanted of a file is gathered
    into one row, which is bounded as the file is, so a file's content is sent at most once.
    """
    kind = located.schema["key"].dataType
    schema = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL("copy long, ids array<int>").fields])
    wish = F.struct("key", "copy", "offset", "n_tokens")
    asked = located.groupBy("part", "piece").agg(F.collect_list(wish).alias("asked"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                part, piece, _ = _footer(content.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([piece], pa.int32()), pa.array([content.as_py()], pa.binary())],
                    names=["part", "piece", "content"],
                )

    def slice_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.names
        for batch in batches:
            for content, asked in zip(batch.column("content"), batch.column("asked"), strict=True):
                ids = np.frombuffer(content.as_py(), "<u2", len(content.as_py()) // 2)
                wishes = asked.values
                cuts = zip(wishes.field("offset").to_pylist(), wishes.field("n_tokens").to_pylist(), strict=True)
                rows = pa.array([ids[a : a + n].astype(np.int32) for a, n in cuts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([wishes.field("key"), wishes.field("copy"), rows], names=names)

    files = _content(spark, path).mapInArrow(place, "part int, piece int, content binary")
    return files.join(asked, ["part", "piece"]).select("content", "asked").mapInArrow(slice_, schema)


def keyed_digests(spark: SparkSession, files: str, index: str, keys: DataFrame, id_col: str) -> DataFrame:
    """Every key looked up in the index, with the digest of the ids that lie at its place.

    ``start`` and ``n_tokens`` come from the index, the digests from the files read as
    a whole: a few figures a document meet by file and offset, instead of the ids themselves.
    """
    counted = keys.groupBy(F.col(f"`{id_col}`").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    wanted = counted.select("key", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
    located = locate(spark, index, wanted, copy_col="copy")
    kind = keys.schema[id_col].dataType
    read = read_documents(spark, files, kind).drop("key", "at")
    return located.join(read, ["part", "piece", "offset", "n_tokens"]).select(
        F.col("key").alias(id_col), "start", "n_tokens", "ids_crc32"
    )
