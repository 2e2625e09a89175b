"""Counts and checks over whole tables, each in one pass with map-side aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from starloom import rules
from starloom.functions.numbers import percent


def row_copies(df: DataFrame, name: str = "count") -> DataFrame:
    """Each distinct row once, with the number of its copies.

    Copies are counted before the shuffle, so a row repeated without limit still sends
    one record per map task. Full dedup and the duplicate audit are both read off this.
    """
    return df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias(name))


def sorted_copies(df: DataFrame, order: Sequence[str], name: str = "count") -> DataFrame:
    """As ``row_copies``, for rows that were dealt by some of their columns, so that copies are in one task.

    ``order`` names all columns, as a ranking that follows sorts by them: copies are next to each other there, so
    the one sort does for both and no table of all rows is held. Rows are held that differ in the last column alone.
    """
    if sorted(order) != sorted(df.columns):
        raise ValueError("copies are equal in all columns")
    columns = [F.col(f"`{c}`") for c in order]
    window = Window.partitionBy(*columns[:-1]).orderBy(columns[-1].asc_nulls_first())
    copies = F.count(F.lit(1)).over(window.rangeBetween(Window.currentRow, Window.currentRow))
    numbered = df.withColumns({name: copies, "__copy": F.row_number().over(window) - F.rank().over(window)})
    return numbered.filter("__copy = 0").drop("__copy")


def duplicate_rows(df: DataFrame, name: str = "count") -> DataFrame:
    """One row per group of fully equal rows, with the group's size."""
    return row_copies(df, name).filter(F.col(name) > 1)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, most frequent first; equal counts in the order of the values."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), *[F.col(c).asc_nulls_first() for c in columns])
    )


def count_where(conditions: Mapping[str, Column]) -> list[Column]:
    """One conditional count per name; NULL conditions do not count."""
    return [F.count_if(condition).alias(name) for name, condition in conditions.items()]


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    return df.agg(*count_where(conditions))


def number_profile(df: DataFrame, column: str) -> DataFrame:
    """Minimum, maximum, mean, and the numbers of negative and NULL values."""
    c = F.col(column)
    return df.agg(
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
        F.avg(c).alias("mean_value"),
        *count_where({"n_negative": c < 0, "n_null": c.isNull()}),
    )


def quality_summary(df: DataFrame) -> DataFrame:
    """Roll-up of ``quality_score`` and ``completement_valide``."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("completement_valide").alias("n_fully_valid"),
        F.avg("quality_score").alias("avg_score"),
        F.min("quality_score").alias("min_score"),
        F.max("quality_score").alias("max_score"),
    ).withColumn("pct_fully_valid", percent(F.col("n_fully_valid"), F.col("n_rows")))


def conformity(silver: DataFrame) -> DataFrame:
    """Rows with an accepted category, price and channel, and NULL references, with shares."""
    counts = silver.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *count_where(
            {
                "categories_ok": F.col("ticket_category").isin(*rules.CATEGORIES),
                "prices_ok": F.col("ticket_price_mad") >= 0,
                "channels_ok": F.col("purchase_channel").isin(*rules.CHANNELS),
                "match_id_null": F.col("match_id").isNull(),
                "stadium_id_null": F.col("stadium_id").isNull(),
            }
        ),
    )
    return counts.withColumns(
        {
            f"pct_{name}": percent(F.col(name), F.col("n_rows"))
            for name in ("categories_ok", "prices_ok", "channels_ok")
        }
    )


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Total rows, distinct keys, NULL keys, and whether every row has its own key."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.col(key)).alias("n_keys"),
        F.count_if(F.col(key).isNull()).alias("n_null"),
    ).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def orphans(fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key: fact rows and distinct keys without a dimension row.

    The fact is first counted per key, so the anti joins see one row per key, however
    the rows are spread over the keys.
    """
    parts = None
    for key, (dim, dim_key) in references.items():
        used = fact.groupBy(F.col(key).cast("string").alias("k")).agg(
            F.count(F.lit(1)).alias("n")
        )
        known = dim.select(F.col(dim_key).cast("string").alias("k"))
        missing = used.join(known, "k", "left_anti").agg(
            F.lit(key).alias("foreign_key"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
            F.count(F.lit(1)).alias("orphan_keys"),
        )
        parts = missing if parts is None else parts.unionByName(missing)
    return parts


def observed(df: DataFrame, metrics: Mapping[str, Column], name: str = "metrics"):
    """``df`` carrying aggregate metrics that its next action fills in, and their handle."""
    handle = Observation(name)
    return df.observe(handle, *[c.alias(n) for n, c in metrics.items()]), handle


def sample_rows(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """First ``n`` rows in an order that includes every column, so the sample is stable."""
    rest = [c for c in df.columns if c not in order_by]
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in [*order_by, *rest]]).limit(n)


def sample_per_group(df: DataFrame, groups: Sequence[str], n: int, by: Sequence[str], seed: str = "") -> DataFrame:
    """``n`` rows of every group: those with the smallest hashes of ``by``, so the same ones in each run.

    Equal hashes are told apart by all columns. The limit on the rank cuts every group down before the
    shuffle, so a group of any size sends ``n`` rows a task.
    """
    mark = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in by]))
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in groups]
    window = Window.partitionBy(*groups).orderBy(mark, *rest)
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= n).drop("__rank")
