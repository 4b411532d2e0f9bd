"""Joins on strings without comparing all with all: which begin or end others, and which are a few edits apart.

Rows are (scope, key, text); pairs are of keys of one scope. What a join returns is as large as its matches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import cut


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk sorted texts with the stack of those that still begin the current one."""
    place, stack = None, []
    for batch in batches:
        out: list[tuple[str, str, str]] = []
        for spot, scope, text, key, opens, takes in zip(*(c.to_pylist() for c in batch.columns)):
            if (spot, scope) != place:
                place, stack = (spot, scope), []
            while stack and not text.startswith(stack[-1][0]):
                stack.pop()
            if takes:
                for begun, keys in stack:
                    if len(begun) < len(text):
                        out += [(scope, short, key) for short in keys]
            if opens:
                if stack and stack[-1][0] == text:
                    stack[-1][1].append(key)
                else:
                    stack.append((text, [key]))
            if len(out) >= 50_000:
                yield _pairs(out)
                out = []
        if out:
            yield _pairs(out)


def _pairs(rows: list[tuple[str, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["scope", "short", "long"])


def prefix_join(rows: DataFrame, opens: Column, takes: Column, tag: str = "prefixes") -> DataFrame:
    """scope, short, long: a row of ``opens`` whose text begins the longer text of a row of ``takes``.

    Texts are dealt out by ranges and sorted once. All that a text begins follow it without a gap, so a walk with the
    texts that are still open finds the matches; a text that is open where a range begins is a prefix of that range's
    first text, and is joined to it by that. A row may come several times with other texts, as may a pair.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("scope", "text", "key", opens.alias("opens"), takes.alias("takes")).filter("opens OR takes")
    dealt = cut(dealt.repartitionByRange(n, "scope", "text").withColumn("spot", F.spark_partition_id()), tag)
    firsts = dealt.groupBy("spot").agg(F.min(F.struct("scope", "text")).alias("m")).filter("length(m.text) > 1")
    begun = F.explode(F.transform(F.sequence(F.lit(1), F.length("m.text") - 1), lambda i: F.left(F.col("m.text"), i)))
    carried = firsts.select("spot", F.col("m.scope").alias("scope"), begun.alias("text"))  # a row for each range and letter
    carried = carried.join(dealt.filter("opens").select("scope", "text", "key"), ["scope", "text"])
    columns = ["spot", "scope", "text", "key", "opens", "takes"]
    both = dealt.select(*columns).unionByName(carried.withColumns({"opens": F.lit(True), "takes": F.lit(False)}).select(*columns))
    both = both.repartition(n, "spot").sortWithinPartitions("spot", "scope", "text")
    return both.mapInArrow(_scan, "scope string, short string, long string")


def deletions(text: Column, most: int) -> Column:
    """The text, and all that is left of it without up to ``most`` (1 or 2) of its characters; texts are longer than that."""
    one = lambda t: F.transform(
        F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.left(t, i - 1), F.substring(t, i + 1, F.length(t)))
    )
    less = one(text) if most == 1 else F.flatten(F.array(one(text), F.flatten(F.transform(one(text), one))))
    return F.array_distinct(F.concat(F.array(text), less))


def edit_join(rows: DataFrame, most: Column) -> DataFrame:
    """scope, a, b with a < b: texts that share a form with up to ``most`` (1 or 2 by row) characters deleted.

    These are all pairs within that many edits of each other, and some that are not: callers verify.
    """
    forms = F.when(most == 1, deletions(F.col("text"), 1)).otherwise(deletions(F.col("text"), 2))
    listed = rows.select("scope", "key", "text", F.explode(F.transform(forms, lambda f: F.xxhash64(f))).alias("form"))
    left, right = listed.withColumnsRenamed({"key": "a", "text": "ta"}), listed.withColumnsRenamed({"key": "b", "text": "tb"})
    near = (F.col("a") < F.col("b")) & (F.levenshtein("ta", "tb", 2) >= 0)
    return left.join(right, ["scope", "form"]).filter(near).select("scope", "a", "b").distinct()


def _slips(text: Column, head: Column, length: Column) -> Column:
    """Keys of texts of 10 to 19 characters, one of which may differ: the rest, with its place."""
    return F.transform(
        F.sequence(F.lit(1), length), lambda i: F.xxhash64(head, length, i, F.left(text, i - 1), F.substring(text, i + 1, length))
    )


def _parts(text: Column, head: Column, length: Column, shifts: bool) -> Column:
    """Keys of texts of 20 characters or more with an edit for every ten: one part more than edits stays whole, moved by no more."""
    edits = F.floor(length / 10).cast("int")
    start = lambda j: F.floor(j * length / (edits + 1)).cast("int")
    of = lambda j, d: F.xxhash64(head, length, j, F.substring(text, start(j) + 1 + d, start(j + 1) - start(j)))
    moved = lambda j: F.transform(F.filter(F.sequence(-edits, edits), lambda d: start(j) + d >= 0), lambda d: of(j, d))
    each = F.sequence(F.lit(0), edits)
    return F.flatten(F.transform(each, moved)) if shifts else F.transform(each, lambda j: of(j, F.lit(0)))


def clip_join(rows: DataFrame, side: str, head: Column) -> DataFrame:
    """scope, short, long: texts of 10 characters or more that come near the beginning (``side`` left) or end (right) of a longer text.

    Near is one edit for every ten characters between texts of one length. ``head`` has to be equal. Callers verify.
    """
    cut_off = F.left if side == "left" else F.right
    size = F.length("text")
    none = F.expr("cast(array() as array<bigint>)")
    own = F.when(size.between(10, 19), _slips(F.col("text"), head, size)).when(size >= 20, _parts(F.col("text"), head, size, False)).otherwise(none)
    span = lambda lo, hi: F.when(hi >= lo, F.sequence(F.lit(lo), hi)).otherwise(F.expr("cast(array() as array<int>)"))
    part = lambda n: cut_off(F.col("text"), n)
    slips = F.flatten(F.transform(span(10, F.least(size - 1, F.lit(19))), lambda n: _slips(part(n), head, n)))
    parts = F.flatten(F.transform(span(20, size - 1), lambda n: _parts(part(n), head, n, True)))
    short = rows.select("scope", F.col("key").alias("short"), F.col("text").alias("ts"), F.explode(own).alias("form"))
    long = rows.select("scope", F.col("key").alias("long"), F.col("text").alias("tl"), F.explode(F.array_distinct(F.concat(slips, parts))).alias("form"))
    edits = F.levenshtein("ts", cut_off(F.col("tl"), F.length("ts")))
    near = (F.length("ts") < F.length("tl")) & (edits * 10 <= F.length("ts"))
    return short.join(long, ["scope", "form"]).filter(near).select("scope", "short", "long").distinct()
