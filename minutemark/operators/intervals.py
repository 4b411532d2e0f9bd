"""Run-length encoded tracks as intervals: change detection, gaps, islands and overlap joins.

All times are BIGINT microseconds. ``keys`` name what a track belongs to
(usually the meeting), so that every window and join is partitioned by them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..shared import cut

FOREVER = 2**62


def _ordered(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def rle_changes(reads: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """The rows whose ``value`` differs from the row before; a track's first row always stays. Null is a value."""
    w = _ordered(keys, order)
    marked = reads.withColumn("_first", F.row_number().over(w) == 1).withColumn("_before", F.lag(value).over(w))
    return marked.filter(F.col("_first") | ~F.col(value).eqNullSafe(F.col("_before"))).drop("_first", "_before")


def first_seen(reads: DataFrame, keys: list[str], order: str, value: str, without: str) -> DataFrame:
    """Distinct values but ``without``, each with its first place in the track."""
    return reads.filter(F.col(value) != without).groupBy(*keys, value).agg(F.min(order).alias("first_ord"))


def to_intervals(changes: DataFrame, keys: list[str], order: list[str], last_end: Column | int = FOREVER, lag_us: int = 0) -> DataFrame:
    """Hold each change until the next: adds s_us and e_us, the last ending at ``last_end``; both moved back by ``lag_us``."""
    end = F.coalesce(F.lead("t_us").over(_ordered(keys, order)), last_end if isinstance(last_end, Column) else F.lit(last_end))
    return changes.withColumn("e_us", end - lag_us).withColumn("s_us", F.col("t_us") - lag_us)


def dwell_intervals(changes: DataFrame, keys: list[str], order: list[str], duration: Column) -> DataFrame:
    """Intervals on screen: the last one ends with the meeting but lasts a second at least; empty ones go."""
    last = F.greatest(duration, F.col("t_us") + 1_000_000)
    return to_intervals(changes, keys, order, last).filter("e_us > s_us")


def gap_fill(intervals: DataFrame, keys: list[str], label: str, most_us: int, gap: str = "Other") -> DataFrame:
    """A gap of at most ``most_us`` between two intervals of one label gets that label.

    Neighbours are those of the input, so of two gaps in a row neither is filled.
    """
    w = _ordered(keys, ["s_us"])
    before, after = F.lag(label).over(w), F.lead(label).over(w)
    fills = (
        (F.col(label) == gap) & (F.col("e_us") - F.col("s_us") <= most_us) & (F.col("_b") == F.col("_a")) & (F.col("_b") != gap)
    )
    marked = intervals.withColumns({"_b": before, "_a": after})
    return marked.withColumn(label, F.when(fills, F.col("_b")).otherwise(F.col(label))).drop("_b", "_a")


def coalesce_runs(changes: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """Changes that change nothing go."""
    return rle_changes(changes, keys, order, label)


def time_on(changes: DataFrame, keys: list[str], order: list[str], label: str, duration: Column) -> DataFrame:
    """Microseconds of each label, negative spans counting as none."""
    held = to_intervals(changes, keys, order, duration)
    return held.groupBy(*keys, label).agg(F.sum(F.greatest(F.lit(0), F.col("e_us") - F.col("s_us"))).alias("us"))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of intervals of one key that overlap, with ``us``, how long. Both sides have s_us and e_us; rows with a null time or key have no pairs.

    A sweep over ranges of (keys, start): of two intervals that overlap, one starts while the other is open. Each
    interval is dealt out by its start, and listed once more in every later range of its key in which it is still open, so a
    key of any size spreads over all tasks. In a range those that start inside an interval are a stretch of the
    sorted starts, found by binary search, and a pair comes where its later interval starts.
    """
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = lambda df, own, other: df.filter("e_us > s_us").select(
        *keys, "s_us", "e_us", F.struct(*df.columns).alias(own), F.lit(None).cast(other.schema.simpleString()).alias("_r" if own == "_l" else "_l")
    )
    both = cut(side(left, "_l", right).unionByName(side(right, "_r", left)).dropna(subset=keys), "intervals")
    ranged = cut(both.repartitionByRange(n, *keys, "s_us").withColumn("_spot", F.spark_partition_id()), "sweep")
    starts = ranged.groupBy(*keys, "_spot").agg(F.min("s_us").alias("first"))
    borders = starts.groupBy(*keys).agg(F.collect_list(F.struct("first", "_spot")).alias("_borders")).filter("size(_borders) > 1")
    # Fewer keys than ranges lie in several of them, and each range begins once.
    open_ = F.explode(F.filter("_borders", lambda b: (b["first"] > F.col("s_us")) & (b["first"] < F.col("e_us")) & (b["_spot"] != F.col("_spot"))))
    carried = ranged.join(borders, keys).withColumn("_at", open_).withColumn("_spot", F.col("_at._spot")).drop("_borders", "_at").withColumn("_old", F.lit(True))
    dealt = ranged.withColumn("_old", F.lit(False)).unionByName(carried).repartition(n, "_spot").sortWithinPartitions("_spot", *keys, "s_us")
    out = StructType([*left.schema.fields, *[f for f in right.schema.fields if f.name not in (*keys, "s_us", "e_us")], StructField("_s", LongType()), StructField("_e", LongType())])
    names = [f.name for f in out.fields]

    n_left = len(left.columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held := list(batches):  # a task's ranges
            table = pa.Table.from_batches(held).combine_chunks()
            yield from _swept(table, _groups(table, ["_spot", *keys]), n_left, names)

    pairs = dealt.mapInArrow(run, out)
    return pairs.withColumn("us", F.least("e_us", "_e") - F.greatest("s_us", "_s"))


def overlap_join_by_buckets(left: DataFrame, right: DataFrame, keys: list[str], bucket_us: int) -> DataFrame:
    """The same pairs by an equi-join on stretches of time, in built-in expressions only.

    Each interval is listed in the stretches that it touches, and a pair is reported in the first that both touch. Ends
    beyond the last left interval of the key are cut there first. It suits intervals that are short for a stretch.
    """
    reach = left.groupBy(*keys).agg(F.min("s_us").alias("_min"), F.max("e_us").alias("_max"))
    r = right.withColumnsRenamed({"s_us": "_s", "e_us": "_e"}).join(reach, keys).filter("_s < _max AND _e > _min")
    r = r.withColumns({"_cs": F.greatest("_s", "_min"), "_ce": F.least("_e", "_max")})
    step = lambda s, e: F.explode(F.expr(f"sequence(floor({s} / {bucket_us}), floor(({e} - 1) / {bucket_us}))"))
    r = r.withColumn("_bucket", step("_cs", "_ce")).drop("_max", "_min", "_ce")
    both = left.filter("e_us > s_us").withColumn("_bucket", step("s_us", "e_us")).join(r, [*keys, "_bucket"])
    both = both.filter((F.col("_s") < F.col("e_us")) & (F.col("_e") > F.col("s_us")))
    both = both.withColumn("us", F.least("e_us", "_e") - F.greatest("s_us", "_s")).filter("us > 0")
    return both.filter(F.col("_bucket") == F.floor(F.greatest("s_us", "_cs") / bucket_us)).drop("_bucket", "_cs")


def _groups(table: pa.Table, names: list[str]) -> np.ndarray:
    """Numbers the runs of equal values in the named columns, from 0."""
    new = np.zeros(table.num_rows, bool)
    for name in names:
        column = table[name]
        if table.num_rows > 1:
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, table.num_rows - 1)).to_numpy(zero_copy_only=False).astype(bool)
    return np.cumsum(new)


def _swept(table: pa.Table, group: np.ndarray, n_left: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The overlapping pairs of sorted rows of whole groups: those that start in this range while the other is open."""
    s, e = table["s_us"].to_numpy(), table["e_us"].to_numpy()
    is_left = table["_l"].is_valid().to_numpy()
    fresh = ~table["_old"].to_numpy(zero_copy_only=False).astype(bool)
    pairs = []
    for holds, starts, first in ((is_left, ~is_left & fresh, True), (~is_left, is_left & fresh, False)):
        a, b = np.flatnonzero(holds), np.flatnonzero(starts)
        # Starts of one side, sorted by group and time, as one order: groups are shifted apart by ranks of time.
        ranks = np.unique(np.concatenate([s, e]))
        width = len(ranks) + 1
        point = group[b] * width + np.searchsorted(ranks, s[b])
        low = np.searchsorted(point, group[a] * width + np.searchsorted(ranks, s[a]), "left" if first else "right")
        high = np.searchsorted(point, group[a] * width + np.searchsorted(ranks, e[a]), "left")
        many = np.maximum(high - low, 0)
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
        one, two = np.repeat(a, many), b[at]
        pairs.append((one, two) if first else (two, one))
    lefts, rights = (np.concatenate(x) for x in zip(*pairs))
    for lo in range(0, len(lefts), 50_000):
        l, r = pa.array(lefts[lo : lo + 50_000]), pa.array(rights[lo : lo + 50_000])
        own, other = table["_l"].combine_chunks().take(l), table["_r"].combine_chunks().take(r)
        own, other = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (own, other))
        columns = [*own.flatten()[:n_left], *[other.field(n) for n in names[n_left:-2]], other.field("s_us"), other.field("e_us")]
        yield pa.RecordBatch.from_arrays(columns, names)


def islands(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Number the runs of neighbours with one value, from 0."""
    w = _ordered(keys, order)
    new = F.when(F.row_number().over(w) == 1, 0).otherwise((~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"))
    return rows.withColumn("_new", new).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def top_by(rows: DataFrame, keys: list[str], measure: str, tie: str) -> DataFrame:
    """The row of the largest measure of each key; of equal ones the smallest ``tie``."""
    w = Window.partitionBy(*keys).orderBy(F.desc(measure), F.asc(tie))
    return rows.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
