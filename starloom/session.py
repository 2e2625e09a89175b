"""Where intermediate tables go, and how they are written.

Lineage is cut by writing a Parquet table in the shared folder the cluster names in
``spark.checkpoint.dir``, so a lost executor costs a re-read, never a recomputation
that could pick other rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's setting, else the warehouse.

    Both are folders that the deployment shares between the driver and all executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, under the work folder."""
    return f"{work_folder(spark)}/starloom/{label}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextmanager
def removing_intermediates(spark: SparkSession) -> Iterator[None]:
    """What is stored by ``materialize`` inside is removed at the end, also after a failure.

    What is returned from inside has to be written, or stored with ``keep``.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes[:] = [scope for scope in _scopes if scope is not made]
        for path in made:
            remove_intermediate(spark, path)


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """SQL settings of the session inside, as they were afterwards. Not for several threads at once."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.exists(target))


def remove_intermediate(spark: SparkSession, path: str) -> bool:
    """Delete an intermediate dataset; refuses anything outside the work folder."""
    if not path.startswith(f"{work_folder(spark)}/") or ".." in path:
        raise ValueError(f"{path} is not an intermediate dataset")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.delete(target, True))


def materialize(
    df: DataFrame, label: str = "stage", row_id: str | None = None, keep: bool = False
) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    ``keep``: it outlives ``removing_intermediates``, for results that are read later.

    ``row_id`` adds a unique long per row. The number is only meaningful because it is
    stored: its high bits are the writing task's partition, its low 33 bits the position
    of the row inside that partition.
    """
    if row_id is not None:
        df = df.withColumn(row_id, F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, label)
    if _scopes and not keep:
        _scopes[-1].append(path)
    # Written once and read soon: the smaller codec, whatever the session's default for tables.
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
