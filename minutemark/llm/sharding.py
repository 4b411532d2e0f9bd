"""Contiguous shards of near equal size from global prefix sums of the byte sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ordered_prefix, text_or_empty


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Deal ``docs``, in the order of doc_id, into ``shards`` runs of near equal bytes.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law
    ('bytes'), shard (from 0), slot (the place in the shard, from 0 without
    gaps) and grown_shard (null under this law).

    A document belongs to the shard in which the middle of its bytes lies when
    all sizes are laid end to end, so a shard's size differs from the mean by
    less than the largest document. A null text has no bytes. Null doc_ids come
    first; rows with one doc_id follow each other by checksum and size, and rows
    equal in these too are interchangeable. Other columns are not read. No rows
    in, no rows out; with fewer rows than shards some shards stay empty.
    """
    text = text_or_empty()
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = ordered_prefix(sized, ["doc_id", "text_crc32", "size"], {"before": "size"}, "shard-sizes")
    middle = (2 * F.col("before") + F.col("size")) * F.lit(shards)
    placed = cut(
        placed.select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.floor(middle / (2 * F.col("before_total"))), F.lit(shards - 1)).cast("int").alias("shard"),
            "_index",
        ),
        "shards",
    )
    first = placed.groupBy("shard").agg(F.min("_index").alias("_first"))  # as many rows as shards
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_index") - F.col("_first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
