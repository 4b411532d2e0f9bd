"""Helpers that several operators share: the shared folder, cut lineage, words, global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import cut, shared_dir  # noqa: F401  the operators take both from here

#: What separates words, in every operator that counts or shingles them.
WORD = r"[^\x20\x09-\x0D]+"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def unused(df: DataFrame, stem: str) -> str:
    """A name for a helper column that no column of ``df`` has, whatever their case."""
    taken, name = {c.lower() for c in df.columns}, f"_{stem}"
    while name in taken:
        name = f"_{name}"
    return name


def word_count(text: Column) -> Column:
    """Number of words, without building them: runs of separators, less the leading and closing ones."""
    squeezed = F.regexp_replace(text, WORD, "w")
    return F.length(squeezed) - F.length(F.replace(squeezed, F.lit("w"), F.lit("")))


def ordered_prefix(df: DataFrame, order: list[str], sums: dict[str, str], tag: str) -> DataFrame:
    """Add exclusive global prefix sums in the order of the columns ``order``.

    ``sums`` maps a new column to the column it adds up; each also gets a
    ``<new>_total`` over all rows. ``_index`` is the row's place from 0 and
    ``_count`` the number of rows.

    The rows are range-partitioned and written once. Each partition's totals
    (as many rows as partitions, whatever the input) give its starting values;
    the running sums inside a partition are a window over that partition. No
    task sees more than one range, and no key is gathered: rows that tie in
    ``order`` may be counted in either sequence.
    """
    spark = df.sparkSession
    n = partitions(spark)
    ranged = cut(
        df.repartitionByRange(n, *[F.col(c) for c in order]).withColumn("_range", F.spark_partition_id()),
        tag,
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    totals = ranged.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{new}") for new, c in sums.items()]
    )
    starts = totals.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_i0"),
        F.sum("_n").over(every).alias("_count"),
        *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_s_{new}") for new in sums],
        *[F.sum(f"_t_{new}").over(every).alias(f"{new}_total") for new in sums],
    )
    # One row per range, and n is a setting, not a property of the data.
    out = ranged.join(F.broadcast(starts), "_range")
    within = Window.partitionBy("_range").orderBy(*order)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("_index", F.col("_i0") + F.row_number().over(within) - 1)
    for new, c in sums.items():
        out = out.withColumn(new, F.col(f"_s_{new}") + F.coalesce(F.sum(c).over(earlier), F.lit(0)))
    return out.drop("_range", "_i0", *[f"_s_{new}" for new in sums])
