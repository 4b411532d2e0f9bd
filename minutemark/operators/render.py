"""Transcripts as text, SRT and WebVTT, one string for each meeting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import timestamp


def readable(turns: DataFrame) -> DataFrame:
    return turns.withColumn("speaker", F.coalesce("speaker_name", F.lit("Other")))


def _joined(turns: DataFrame, cue: Column, separator: str, before: str = "", after: str = "") -> DataFrame:
    """A meeting's cues are one file, so they meet in one row."""
    rows = turns.select("meeting", F.struct("turn", cue.alias("cue")).alias("c"))
    cues = F.array_sort(F.collect_list("c"))["cue"]
    return rows.groupBy("meeting").agg(F.concat(F.lit(before), F.array_join(cues, separator), F.lit(after)).alias("value"))


def to_text(turns: DataFrame, timestamps: bool = True) -> DataFrame:
    said = F.concat("speaker", F.lit(": "), F.btrim("text"))
    times = F.concat(F.lit("("), timestamp(F.col("s_us"), "."), F.lit(" - "), timestamp(F.col("e_us"), "."), F.lit(") "))
    return _joined(turns, F.concat(times, said) if timestamps else said, "\n\n")


def to_srt(turns: DataFrame) -> DataFrame:
    number = F.row_number().over(Window.partitionBy("meeting").orderBy("turn"))
    numbered = turns.withColumn("_n", number)
    cue = F.concat(
        F.col("_n").cast("string"), F.lit("\n"), timestamp(F.col("s_us"), ","), F.lit(" --> "), timestamp(F.col("e_us"), ","),
        F.lit("\n"), "speaker", F.lit(": "), F.btrim("text"),
    )
    return _joined(numbered, cue, "\n\n", after="\n")


def to_vtt(turns: DataFrame) -> DataFrame:
    cue = F.concat(
        timestamp(F.col("s_us"), "."), F.lit(" --> "), timestamp(F.col("e_us"), "."), F.lit("\n<v "), "speaker", F.lit(">"), F.btrim("text"), F.lit("\n")
    )
    return _joined(turns, cue, "\n", before="WEBVTT\n\n")


FORMATS = {"txt": to_text, "srt": to_srt, "vtt": to_vtt}
