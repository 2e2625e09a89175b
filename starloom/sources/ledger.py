"""Landing of only those files that no earlier run has landed.

The ledger is a table of the files a run took: path, size and time of change. It is appended by run,
like the rows, so a run that failed or is repeated replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import materialize, path_exists
from starloom.sources.writers import append_run

FILE = ["file_path", "file_size", "file_modification_time"]
SCHEMA = "file_path string, file_size long, file_modification_time timestamp, run_id string"


def files_in(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The files below a folder, with size and time of change; their content is not read."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern)
    return files.load(folder).select("path", *[f"_metadata.{c}" for c in FILE])


def ledger_of(spark: SparkSession, path: str) -> DataFrame:
    """All files ever taken, with their run; empty before the first one."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def new_files(spark: SparkSession, folder: str, ledger: str, run: str, pattern: str = "*") -> DataFrame:
    """Files that no other run has taken as they are now. A file that was changed is new again."""
    taken = ledger_of(spark, ledger).filter(F.col("run_id") != run).select(*FILE)
    return files_in(spark, folder, pattern).join(taken, FILE, "left_anti")


def land_new(
    spark: SparkSession,
    folder: str,
    target: str,
    ledger: str,
    run: str,
    schema: T.StructType,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    pattern: str = "*",
) -> int:
    """Add the rows of new files to ``target`` with their file; returns the number of rows.

    The ledger is written after the rows. A run that ends in between is repeated under its name,
    finds the same files and replaces its rows.
    """
    new = materialize(new_files(spark, folder, ledger, run, pattern), "new_files")
    paths = [row.path for row in new.select("path").toLocalIterator()]  # Spark's reader lists files in the driver, too
    reader = spark.read.format(fmt).schema(schema).options(**(options or {}))
    rows = reader.load(paths) if paths else spark.createDataFrame([], schema)
    origin: Column = F.col("_metadata.file_path") if paths else F.lit(None).cast("string")
    written = append_run(rows.withColumn("source_file", origin), target, run)
    append_run(new.select(*FILE), ledger, run)
    return written


def read_landed(spark: SparkSession, target: str, ledger: str, schema: T.StructType) -> DataFrame:
    """Rows of every file as it was last landed, with ``source_file`` and ``run_id``.

    What an earlier run read from a file that has been changed since is left out.
    """
    last = ledger_of(spark, ledger).groupBy(F.col("file_path").alias("source_file")).agg(
        F.max_by("run_id", F.struct("file_modification_time", "run_id")).alias("run_id")
    )
    stored = T.StructType([*schema, T.StructField("source_file", T.StringType()), T.StructField("run_id", T.StringType())])
    return spark.read.schema(stored).parquet(target).join(last, ["source_file", "run_id"], "left_semi")
