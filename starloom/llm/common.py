"""What several corpus operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import materialize, removing_intermediates

__all__ = [
    "ascii_lower", "batches_of", "lower_bytes", "materialize", "removing_intermediates", "table",
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of lower-cased UTF-8: digits, a-z and everything beyond ASCII.
ALNUM_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Only A-Z lower-cased. ``lower`` does the same on pure ASCII, and much faster."""
    pure = F.octet_length(text) == F.length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def lower_bytes(text: str | None) -> bytes:
    """UTF-8 of a text with only A-Z lower-cased; no text is an empty one."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").lower()


def batches_of(
    batches: Iterator[pa.RecordBatch], text: str, size: int
) -> Iterator[pa.RecordBatch]:
    """Consecutive pieces of the input with about ``size`` bytes of text, or one row beyond it.

    Rows stay whole and in order, and none is left out.
    """
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(lengths):
            if total and total + n > size:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)
