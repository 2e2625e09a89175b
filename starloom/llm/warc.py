"""A content-addressed web archive: payloads once, record headers apart, records by join.

``write_archive`` stores two tables in one folder. ``payloads`` has the bytes of every distinct
payload once, compressed, under its SHA-256, which is verified against a second digest and the
length when written and against the bytes when read. ``headers`` has each record's exact header
lines and the digest its payload is found by. ``read_archive`` joins them to whole records again;
the records of a payload that many share are dealt over copies of it, a copy for every
``SPREAD_BYTES`` of records. ``write_warc`` and ``read_warc`` exchange records with ordinary WARC
files, and ``describe_files`` tells what the records of such files hold.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import batches_of

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
ID = "urn:page:"
#: Bytes of payloads handled at a time, and of records that share a copy of their payload.
CHUNK_BYTES = 4 << 20
SPREAD_BYTES = 32 << 20
#: Records in a WARC file at most.
FILE_RECORDS = 4096
#: Digests with several copies that are broadcast at most, of about a hundred bytes each.
BROADCAST_ROWS = 100_000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1, 20 bits at a time."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches_of(batches, "payload", CHUNK_BYTES):
        packed = pa.array([pack(x) for x in batch.column("payload").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("sha256"), packed], names=["sha256", "payload"])


def _header(kind: Column, page: Column, uri: Column, sha1: Column, length: Column, original: Column) -> Column:
    def line(name: str, *value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), *[F.lit(v) if isinstance(v, str) else v for v in value], F.lit(CRLF))

    def urn(number: Column) -> Column:
        return F.concat(F.lit(f"<{ID}"), F.coalesce(number.cast("string"), F.lit("")), F.lit(">"))

    revisit = kind == "revisit"
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", kind),
        line("WARC-Record-ID", urn(page)),
        line("WARC-Date", DATE),
        F.when(uri.isNotNull(), line("WARC-Target-URI", F.regexp_replace(uri, "[\\r\\n]", "%0A"))).otherwise(""),
        line("WARC-Payload-Digest", "sha1:", sha1),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                line("WARC-Refers-To", urn(original)),
            ),
        ).otherwise(F.lit("")),
        F.when(~revisit, line("Content-Type", "text/html; charset=utf-8")).otherwise(F.lit("")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(length).cast("string")),
        F.lit(CRLF),
    )


def write_archive(
    pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", uri_col: str = "url",
    html_col: str = "html",
) -> None:
    """Archive a page per record under ``folder``.

    Of pages with equal payloads of at least ``min_bytes``, the one with the smallest id is
    the response and the others revisit it; shorter payloads are all responses. The table of
    payloads has each once all the same.

    Html may be text, stored in UTF-8, or bytes of any kind. NULL html is an empty payload, a NULL url leaves out its line. Rows that repeat the
    smallest id are all responses. A NULL id ranks after all others; alone with its payload it
    is a response. Other columns are not read. An empty table gives an empty archive.
    """
    payload = F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{uri_col}`").alias("uri"), payload.alias("payload")
    ).select(
        "page_id", "uri", "payload", F.sha2("payload", 256).alias("sha256"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )
    marks = rows.select("page_id", "uri", "sha256", "bytes", base32_sha1(F.col("payload")).alias("sha1"))
    # One group per digest: few numbers, combined before the shuffle. The digest is verified
    # by a second one and the length: equal SHA-256 with either differing stops the job.
    firsts = marks.groupBy("sha256").agg(
        F.min("page_id").alias("original"),
        F.min("sha1").alias("low"), F.max("sha1").alias("high"),
        F.min("bytes").alias("least"), F.max("bytes").alias("most"), F.count(F.lit(1)).alias("n"),
    )
    same = (F.col("low") == F.col("high")) & (F.col("least") == F.col("most"))
    firsts = firsts.select(
        "sha256", F.when(same, F.col("original")).otherwise(
            F.raise_error(F.concat(F.lit("payloads differ under one digest: "), "sha256")).cast("long")
        ).alias("original"),
        _copies(F.col("n"), F.col("most")).alias("copies"),
    )
    joined = marks.join(firsts, "sha256")
    again = F.coalesce(F.col("page_id") != F.col("original"), F.col("original").isNotNull())
    kind = F.when(again & (F.col("bytes") >= min_bytes), "revisit").otherwise("response")
    header = _header(kind, *[F.col(c) for c in ("page_id", "uri", "sha1", "bytes", "original")])
    copy = F.pmod(F.xxhash64("page_id", "uri"), "copies").cast("int")
    listed = joined.select("page_id", header.alias("header"), "sha256", copy.alias("copy"), "copies")
    listed.write.mode("overwrite").parquet(f"{folder}/headers")
    # Equal digests are verified to be equal payloads above, so any of them may stand for all:
    # copies go before the shuffle, and payloads are shuffled once, compressed.
    packed = rows.select("sha256", "payload").mapInArrow(_packed, "sha256 string, payload binary")
    stored = packed.groupBy("sha256").agg(F.first("payload").alias("payload"))
    stored.write.mode("overwrite").option("compression", "none").parquet(f"{folder}/payloads")


def _copies(records: Column, size: Column) -> Column:
    """Over how many copies of a payload its records are dealt."""
    return F.greatest(F.lit(1), F.least(records, F.ceil(records * size / SPREAD_BYTES))).cast("int")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads as they were; one that has not the digest it is stored under stops the job."""
    unpack, last, payload = zstandard.ZstdDecompressor(), None, b""
    for batch in batches:
        others = [x for x in batch.schema.names if x != "payload"]
        start, held, payloads = 0, 0, []
        for row, key in enumerate(batch.column("sha256").to_pylist()):
            if key != last:  # a join leaves the records of one payload next to each other
                try:
                    payload, last = unpack.decompress(batch.column("payload")[row].as_py()), key
                except zstandard.ZstdError as e:
                    raise ValueError(f"payload is damaged: {key}") from e
                if hashlib.sha256(payload).hexdigest() != key:
                    raise ValueError(f"payload is damaged: {key}")
            payloads.append(payload)
            held += len(payload)
            if held > CHUNK_BYTES or row + 1 == batch.num_rows:
                part = batch.slice(start, len(payloads))
                columns = [*map(part.column, others), pa.array(payloads, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*others, "payload"])
                start, held, payloads = row + 1, 0, []


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("sha256 string, payload binary").parquet(f"{folder}/payloads")


def headers(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("page_id long, header string, sha256 string, copy int, copies int").parquet(f"{folder}/headers")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, header, payload`` of every record, the payload in full for revisits too."""
    records = headers(spark, folder)
    # Few payloads have several copies, so this table is mostly empty or small.
    several = records.filter("copies > 1").select("sha256", "copies").distinct()
    if several.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # payloads stay where they are
        several = F.broadcast(several)
    last = F.coalesce("copies", F.lit(1)) - 1
    spread = _stored(spark, folder).join(several, "sha256", "left").select(
        "sha256", "payload", F.explode(F.sequence(F.lit(0), last)).alias("copy")
    )
    joined = records.join(spread, ["sha256", "copy"]).select("page_id", "header", "sha256", "payload")
    whole = joined.mapInArrow(_unpacked, "page_id long, header string, sha256 string, payload binary")
    return whole.drop("sha256")


def field(header: Column, name: str) -> Column:
    """Value of a header line, NULL without it."""
    value = F.regexp_extract(header, f"(?md)^{name}: ([^\\r\\n]*)\\r$", 1)
    return F.when(F.contains(header, F.lit(f"\n{name}: ")), value)


def _number(name: str) -> Column:
    return F.regexp_extract(field(F.col("header"), name), f"^<{ID}(.*)>$", 1).try_cast("long")


def describe(spark: SparkSession, folder: str) -> DataFrame:
    """Per record, from the archive: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Payloads are verified and measured once, where they are stored; a record meets only
    these figures, however many share its payload.
    """
    stored = _stored(spark, folder).mapInArrow(_unpacked, "sha256 string, payload binary")
    measured = stored.select(
        "sha256", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    return headers(spark, folder).join(measured, "sha256").select(
        _number("WARC-Record-ID").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        field(F.col("header"), "WARC-Type").alias("record_type"),
        _number("WARC-Refers-To").alias("refers_to"),
    )


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records (header, payload) as WARC files of at most ``FILE_RECORDS``, by Spark's own writer.

    A record ends with two line ends, which is the writer's separator here; what a revisit
    record lacks in its payload is found by its reference. Payloads may be any bytes.
    """
    # A cast, other than decoding, leaves every byte as it is.
    body = F.when(field(F.col("header"), "WARC-Type") == "revisit", F.lit("")).otherwise(
        F.col("payload").cast("string")
    )
    text = records.select(F.concat("header", body).alias("value"))
    writer = text.write.mode("overwrite").option("lineSep", CRLF * 2).option("maxRecordsPerFile", FILE_RECORDS)
    writer.option("compression", compression).text(path)


class _Stream:
    """Bytes of a file, unpacked as they are asked for."""

    def __init__(self, data: bytes):
        self.data, self.at, self.held = memoryview(data), 0, bytearray()
        self.packed = data[:2] == b"\x1f\x8b"
        self.unpack = zlib.decompressobj(31) if self.packed else None

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        piece = bytes(self.data[self.at : self.at + (1 << 16)])
        self.at += len(piece)
        while self.packed and piece:
            self.held += self.unpack.decompress(piece)
            piece = b""
            if self.unpack.eof:  # files may have a member for every record
                piece, self.unpack = self.unpack.unused_data, zlib.decompressobj(31)
        self.held += piece
        return True

    def read(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        if len(self.held) < n:
            raise ValueError("a record ends before its stated length")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def header(self) -> bytes:
        """Up to the next empty line, nothing at the end of the file."""
        end = CRLF.encode() * 2
        start = 0
        while (at := self.held.find(end, start)) < 0:
            start = max(0, len(self.held) - 3)
            if not self._more():
                if self.held:
                    raise ValueError("a record ends within its header")
                return b""
        return self.read(at + 4)


def _records(data: bytes) -> Iterator[tuple[str, bytes]]:
    stream = _Stream(data)
    while header := stream.header():
        length = int(re.search(rb"(?m)^Content-Length: (\d+)\r$", header)[1])
        yield header.decode("utf-8"), stream.read(length)
        stream.read(4)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``header, body`` of every record of WARC files, cut by their stated lengths.

    Files are unpacked as they are read, so a task holds a file as it is stored and ``CHUNK_BYTES`` of
    records, or one record beyond it.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def batch_of(pairs: list[tuple[str, bytes]]) -> pa.RecordBatch:
        columns = [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["header", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                pairs, held = [], 0
                for pair in _records(data.as_py()):
                    pairs.append(pair)
                    held += len(pair[0]) + len(pair[1])
                    if held > CHUNK_BYTES:
                        yield batch_of(pairs)
                        pairs, held = [], 0
                if pairs:
                    yield batch_of(pairs)

    return files.mapInArrow(run, "header string, body binary")


def describe_files(spark: SparkSession, path: str) -> DataFrame:
    """Per record of WARC files: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The payload is the body of a response. A revisit has that of the response it refers to, so it
    meets the two figures taken there, and its own header has to name the same digest. A revisit
    whose response is not in the files has its digest alone.
    """
    records = read_warc(spark, path).select(
        _number("WARC-Record-ID").alias("page_id"),
        F.octet_length("body").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("body")).alias("payload_digest"),
        field(F.col("header"), "WARC-Type").alias("record_type"),
        _number("WARC-Refers-To").alias("refers_to"),
        F.substring(field(F.col("header"), "WARC-Payload-Digest"), 6, 32).alias("stated"),
    )
    wrong = F.raise_error(F.concat(F.lit("payload differs from its header: "), "stated")).cast("string")
    revisit = F.col("record_type") == "revisit"
    whole = records.filter(~revisit).withColumn(
        "payload_digest", F.when(F.col("payload_digest") == F.col("stated"), F.col("stated")).otherwise(wrong)
    ).drop("stated")
    # Rows that repeat an id with equal payloads are one response here.
    named = whole.select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated"), "payload_bytes"
    ).filter("refers_to IS NOT NULL").distinct()
    again = records.filter(revisit).drop("payload_bytes", "payload_digest")
    found = again.join(named, ["refers_to", "stated"], "left").withColumnRenamed("stated", "payload_digest")
    return whole.unionByName(found)
