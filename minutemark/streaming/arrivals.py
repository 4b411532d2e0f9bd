"""Transcripts and tracks as their files arrive: a meeting is ready with both, or told as lacking one once the wait is over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def paired(transcripts: DataFrame, tracks: DataFrame, wait: str = "1 hour") -> DataFrame:
    """meeting, arrived, missing of two streams (meeting, arrived): each meeting once.

    ``missing`` is null for a meeting whose files came within ``wait`` of each other, at the later one's time; else it names
    what had not come when the watermark passed. State is kept for the wait only. A file that comes later than that is a
    meeting of its own. Rows without a meeting only move the time on.
    """
    t = transcripts.select(F.col("meeting").alias("_tm"), F.col("arrived").alias("_ta")).withWatermark("_ta", wait)
    k = tracks.select(F.col("meeting").alias("_km"), F.col("arrived").alias("_ka")).withWatermark("_ka", wait)
    near = (F.col("_tm") == F.col("_km")) & F.expr(f"_ka BETWEEN _ta - INTERVAL {wait} AND _ta + INTERVAL {wait}")
    both = t.join(k, near, "full_outer")
    missing = F.when(F.col("_km").isNull(), "speaker track").when(F.col("_tm").isNull(), "transcript")
    rows = both.select(F.coalesce("_tm", "_km").alias("meeting"), F.greatest("_ta", "_ka").alias("arrived"), missing.alias("missing"))
    return rows.filter("meeting IS NOT NULL")
