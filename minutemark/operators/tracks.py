"""Interval operators for tracks of any length: one track spreads over all tasks.

They do what those of the same names in ``intervals`` do. There a window holds a whole track; here rows are dealt out by
ranges of track and time, each range is scanned alone, and the state at its borders (a row for each range and track) is
combined and handed to the ranges next to it. Times are BIGINT microseconds; null keys and values are keys and values
like others; rows that tie in track and order may come in either sequence. No rows in, no rows out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut
from .intervals import FOREVER


def _ranged(rows: DataFrame, keys: list[str], order: list[str], tag: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()), tag)


def _with_borders(ranged: DataFrame, borders: DataFrame, keys: list[str]) -> DataFrame:
    """``ranged`` with the columns of ``borders``, which has a row for each track and range."""
    same = ranged["_range"] == F.col("_at")
    for i, key in enumerate(keys):
        same &= ranged[key].eqNullSafe(F.col(f"_key{i}"))
    return ranged.join(borders, same).drop("_at", *[f"_key{i}" for i in range(len(keys))])


def _border_keys(keys: list[str]) -> list[Column]:
    return [F.col("_range").alias("_at"), *[F.col(key).alias(f"_key{i}") for i, key in enumerate(keys)]]


def neighbours(
    rows: DataFrame, keys: list[str], order: list[str], before: dict[str, str], after: dict[str, str], keep_range: bool = False
) -> DataFrame:
    """Add columns of the row before (new name to column) and of the row after in the same track; null where there is none."""
    ranged = _ranged(rows, keys, order, "track")
    place, line = F.struct(*order), Window.partitionBy(*keys).orderBy("_range")
    ends = ranged.groupBy(*keys, "_range").agg(
        *[F.max_by(c, place).alias(f"_end_{new}") for new, c in before.items()],
        *[F.min_by(c, place).alias(f"_end_{new}") for new, c in after.items()],
    )
    borders = ends.select(
        *_border_keys(keys),
        *[F.lag(f"_end_{new}").over(line).alias(f"_far_{new}") for new in before],
        *[F.lead(f"_end_{new}").over(line).alias(f"_far_{new}") for new in after],
    )
    within = Window.partitionBy(*keys, "_range").orderBy(*order)
    first, last = F.lag(F.lit(1)).over(within).isNull(), F.lead(F.lit(1)).over(within).isNull()
    out = _with_borders(ranged, borders, keys).withColumns(
        {new: F.when(first, F.col(f"_far_{new}")).otherwise(F.lag(c).over(within)) for new, c in before.items()}
        | {new: F.when(last, F.col(f"_far_{new}")).otherwise(F.lead(c).over(within)) for new, c in after.items()}
    )
    return out.drop(*[f"_far_{new}" for new in (*before, *after)], *([] if keep_range else ["_range"]))


def running_sum(ranged: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` from the track's start to each row; ``ranged`` comes from ``neighbours`` with its ranges."""
    line = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*keys, "_range").agg(F.sum(value).alias("_total"))
    starts = totals.select(*_border_keys(keys), F.coalesce(F.sum("_total").over(line), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = _with_borders(ranged, starts, keys).withColumn(name, F.col("_start") + F.sum(value).over(within))
    return out.drop("_start", "_range")


def rle_changes(reads: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """The rows whose ``value`` differs from the row before; a track's first row always stays."""
    marked = neighbours(reads.withColumn("_row", F.lit(True)), keys, order, {"_had": "_row", "_before": value}, {})
    return marked.filter(F.col("_had").isNull() | ~F.col(value).eqNullSafe(F.col("_before"))).drop("_row", "_had", "_before")


def to_intervals(changes: DataFrame, keys: list[str], order: list[str], last_end: Column | int = FOREVER, lag_us: int = 0) -> DataFrame:
    """Hold each change until the next: adds s_us and e_us, the last ending at ``last_end``; both moved back by ``lag_us``."""
    held = neighbours(changes, keys, order, {}, {"_next": "t_us"})
    end = F.coalesce(F.col("_next"), last_end if isinstance(last_end, Column) else F.lit(last_end))
    return held.withColumn("e_us", end - lag_us).withColumn("s_us", F.col("t_us") - lag_us).drop("_next")


def gap_fill(intervals: DataFrame, keys: list[str], label: str, most_us: int, gap: str = "Other", order: list[str] | None = None) -> DataFrame:
    """A gap of at most ``most_us`` between two intervals of one label gets that label; neighbours are those of the input, by ``order`` or s_us."""
    marked = neighbours(intervals, keys, order or ["s_us"], {"_b": label}, {"_a": label})
    short = F.col("e_us") - F.col("s_us") <= most_us
    fills = (F.col(label) == gap) & short & (F.col("_b") == F.col("_a")) & (F.col("_b") != gap)
    return marked.withColumn(label, F.when(fills, F.col("_b")).otherwise(F.col(label))).drop("_b", "_a")


def islands(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Number the runs of neighbours with one value, from 0."""
    marked = neighbours(rows.withColumn("_row", F.lit(True)), keys, order, {"_had": "_row", "_before": value}, {}, keep_range=True)
    new = F.when(F.col("_had").isNull(), 0).otherwise((~F.col(value).eqNullSafe(F.col("_before"))).cast("int"))
    # Written once: the totals and the sums read the same marks.
    marked = cut(marked.withColumn("_new", new).drop("_row", "_had", "_before"), "track-marks")
    return running_sum(marked, keys, order, "_new", name).drop("_new")
