"""The corpus pipeline: quality, lines, near-duplicates, benchmark passages, packing.

Every stage takes all that its predecessor kept, written as Parquet and read again, and all but
the last return the columns of ``documents``. The classifier is trained on the labelled
documents of the pipeline's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import decontaminate, line_dedup, near_dup, packing, quality
from starloom.llm.common import materialize, table


def _shield(docs: DataFrame):
    """``docs`` with other columns renamed, so none clashes with a result's, and the way back."""
    own = {c: c if c in ("doc_id", "text") else f"__own{i}" for i, c in enumerate(docs.columns)}
    hidden = docs.select(*[F.col(f"`{c}`").alias(own[c]) for c in docs.columns])
    return hidden, own, lambda df: df.select(*[F.col(own[c]).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the trained classifier keep."""
    hidden, _, restore = _shield(docs)
    return restore(quality.quality_rules(hidden, table(spark, sf_dir, "labels")).filter("kept"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others hold too; those left without a word go."""
    hidden, own, restore = _shield(docs)
    cleaned = line_dedup.dedup_lines(hidden)
    changed = F.col("n_dropped") > 0
    if n := own.get("n_chars"):
        cleaned = cleaned.withColumn(n, F.when(changed, F.length("text")).otherwise(F.col(n)).cast("long"))
    return restore(cleaned.filter(~changed | (F.trim("text", F.lit(line_dedup.SPACES)) != "")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    gone = near_dup.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    hidden, _, restore = _shield(docs)
    found = decontaminate.find_contamination(hidden, table(spark, sf_dir, "benchmark"))
    return restore(found.filter(~F.col("contaminated")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, with their token ids, placed in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_shared_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: A trained classifier and a tokenizer have no SQL; the tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
