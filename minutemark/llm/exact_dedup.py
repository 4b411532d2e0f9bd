"""Exact dedup against a persistent digest index, bucketed and sorted by hash."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, partitions, shared_dir, text_or_empty, unused

#: A digest is hot if it holds more than one in so many of a batch's rows, so there are fewer hot ones than this.
HOT_SHARE = 1000


def _with_groups(rows: DataFrame, groups: DataFrame, size: str) -> DataFrame:
    """Join rows to their digests' groups, of which ``size`` has the rows.

    At most HOT_SHARE groups hold more than 1 / HOT_SHARE of the rows: these are
    broadcast, so a text that a third of the rows share never meets in one task;
    all others are joined by digest.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) * HOT_SHARE > total
    hot, rest = F.broadcast(groups.filter(is_hot)), groups.filter(~is_hot)
    others = rows.join(hot.select("digest"), "digest", "left_anti")
    return rows.join(hot, "digest").unionByName(others.join(rest, "digest"))


class DigestIndex:
    """One row for each distinct text that was ever ingested: its digest, the document that stays, and the batch that brought it.

    The table is bucketed and sorted by digest, so an anti-join against it
    shuffles only the new batch. ``location`` makes it outlive the session: give
    the same one again to reopen the index.
    """

    def __init__(self, spark: SparkSession, name: str, location: str | None = None, buckets: int | None = None):
        self.spark, self.name, self.buckets = spark, name, buckets or max(8, partitions(spark))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest STRING, keep_id BIGINT, batch_rows BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{location or shared_dir(spark, 'digests')}'"
        )

    def ingest(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Append the texts of ``docs`` that are new and say of each document whether it stays.

        Returns doc_id, keep_id, group_size, kept, text_sha256. Of equal texts in
        the batch the largest doc_id stays, unless an earlier batch brought the
        text: then the document that the index names stays and none of this batch
        does.

        ``batch`` names the batch (by default each call is a new one). The index
        knows which batch brought a text: a batch that is ingested again under
        its name, as by a driver that failed midway, appends only what is missing
        and gets the same answer as before.

        A null text is the empty text. Rows that repeat both doc_id and text are
        one document and one row of the result; group_size counts the rows. A
        null doc_id stays only where no other document has its text. Other
        columns of ``docs`` are not read. An empty batch gives an empty result.
        """
        return self._ingest(docs, batch or uuid.uuid4().hex).drop("n")

    def _ingest(self, docs: DataFrame, batch: str) -> DataFrame:
        seen = cut(
            docs.select("doc_id", F.sha2(text_or_empty(), 256).alias("digest"))
            .groupBy("digest", "doc_id")
            .agg(F.count(F.lit(1)).alias("n")),
            "digests",
        )
        # Partial sums on the map side leave one row for each digest and task, hot or not.
        groups = cut(
            seen.groupBy("digest").agg(F.max("doc_id").alias("last_id"), F.sum("n").alias("group_size")), "groups"
        )
        index = self.spark.table(self.name).hint("merge")
        earlier = index.filter(F.col("batch") != batch).select("digest", "keep_id", F.lit(True).alias("old"))
        held = groups.join(earlier, "digest", "left").select(
            "digest",
            "group_size",
            F.when(F.col("old"), F.col("keep_id")).otherwise(F.col("last_id")).alias("keep_id"),
            F.coalesce("old", F.lit(False)).alias("old"),
        )
        held = cut(held, "held")
        fresh = groups.join(index.select("digest"), "digest", "left_anti")
        (
            fresh.select("digest", F.col("last_id").alias("keep_id"), F.col("group_size").alias("batch_rows"), F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.insertInto(self.name)
        )
        return _with_groups(seen, held, "group_size").select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("old")).alias("kept"),
            F.col("digest").alias("text_sha256"),
            "n",
        )

    def ingest_parts(self, docs: DataFrame, parts: int = 2, batch: str | None = None) -> DataFrame:
        """``ingest`` in ``parts`` batches of doc_id ranges, the largest ids first, so that the largest of each text stays.

        Returns what ``ingest`` does, of all documents; group_size counts the rows of all parts. Each part is anti-joined
        with what those before it left in the index. The parts have equal ranges of ids; null ids come with the last part.
        """
        ends = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
        low, high = (0, 0) if ends[0] is None else ends
        batch, above, done = batch or uuid.uuid4().hex, None, []
        for k in range(parts):
            edge = low + (high - low) * (parts - 1 - k) // parts
            part = docs if above is None else docs.filter(F.col("doc_id").isNull() | (F.col("doc_id") <= above))
            part = part if k == parts - 1 else part.filter(F.col("doc_id") > edge)
            done.append(self._ingest(part, f"{batch}-{k}"))
            above = edge
        every = cut(reduce(DataFrame.unionByName, done).withColumnRenamed("text_sha256", "digest").drop("group_size"), "decided")
        sizes = cut(every.groupBy("digest").agg(F.sum("n").alias("group_size")), "group-sizes")
        return _with_groups(every, sizes, "group_size").select(
            "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
        )


def drop_copies(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay after ``index.ingest_parts``, with all their columns, each once.

    A null text is the empty text; of rows that repeat doc_id and text any one
    stays. Columns may have any names.
    """
    kept = index.ingest_parts(docs, batch=batch).filter("kept")
    key, none, sha = (unused(docs, x) for x in ("key", "none", "sha"))
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    mine = docs.withColumns({key: id_, none: F.col("doc_id").isNull(), sha: F.sha2(text_or_empty(), 256)})
    kept = kept.select(id_.alias(key), F.col("doc_id").isNull().alias(none), F.col("text_sha256").alias(sha))
    # The texts are dealt once: what repeats is dropped by the columns by which they were joined.
    return mine.join(kept.hint("merge"), [key, none, sha], "left_semi").dropDuplicates([key, none, sha]).select(*docs.columns)
