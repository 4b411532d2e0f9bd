"""From transcripts and cleaned tracks to speaker-attributed transcripts and their files."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import microseconds
from ..operators import attribution as at
from ..operators import render
from ..shared import cut
from ..sources import meetings as src
from .clean import _json


@dataclass
class Merged:
    """turns (with provenance, speaker_name and ocr_label), and what has no partner: (meeting, missing)."""

    turns: DataFrame
    missing: DataFrame


def merge_meetings(asr: DataFrame, speakers: DataFrame, lag: float = 0.6, pure: float = 0.8, screen: float = 0.7, minor: float = 0.1, done: DataFrame | None = None) -> Merged:
    """Attribute the meetings that have both files (as ``sources.meetings`` reads them) and aren't in ``done``."""
    lag_us = round(lag * 1e6)
    ids = lambda d: d.select("meeting").distinct()
    missing = ids(speakers).join(ids(asr), "meeting", "left_anti").withColumn("missing", F.lit("transcript")).unionByName(
        ids(asr).join(ids(speakers), "meeting", "left_anti").withColumn("missing", F.lit("speaker track"))
    )
    ready = ids(asr).join(ids(speakers), "meeting")
    if done is not None:
        ready = ready.join(done, "meeting", "left_anti")
    asr, speakers = asr.join(ready, "meeting", "left_semi"), speakers.join(ready, "meeting", "left_semi")
    changes = src.exploded_changes(speakers, "changes")
    named = at.attribute_segments(src.exploded_segments(asr), changes, lag_us, pure, screen, minor)
    turns = cut(at.merge_turns(named), "turns")
    raw = src.exploded_changes(speakers, "raw_changes")
    to = speakers.select("meeting", F.explode("raw_to_speaker").alias("raw", "speaker"))
    displays = speakers.select("meeting", F.explode("speakers").alias("speaker", "v")).select("meeting", "speaker", "v.display")
    durations = speakers.select("meeting", microseconds(F.col("duration")).alias("duration_us"))
    return Merged(cut(at.label_turns(turns, raw, to, displays, durations, lag_us), "labelled"), missing)


def transcript_files(m: Merged) -> DataFrame:
    turn = F.struct((F.col("s_us") / 1e6).alias("start"), (F.col("e_us") / 1e6).alias("end"), "speaker", "speaker_name", "ocr_label", "text")
    rows = m.turns.groupBy("meeting").agg(F.array_sort(F.collect_list(F.struct("turn", turn.alias("t")))).alias("l"))
    return rows.select("meeting", _json(F.col("l.t")).alias("value"))


def attribution_files(m: Merged, asr: DataFrame, parameters: dict) -> DataFrame:
    by_turn = lambda x, y: F.when(x["turn"] < y["turn"], -1).when(x["turn"] > y["turn"], 1).otherwise(0)  # noqa: E731  maps have no order
    how = F.struct("segments", "screen_segments", "clusters", "screen_share", "source")
    names = F.map_from_entries(F.array_sort(F.collect_set(F.struct("speaker", F.coalesce("speaker_name", "speaker").alias("n")))))
    rows = m.turns.groupBy("meeting").agg(names.alias("display_names"), F.array_sort(F.collect_list(F.struct("turn", how.alias("h"))), by_turn).alias("l"))
    rows = rows.join(asr.select("meeting", F.coalesce("clustered", F.lit(False)).alias("voice_clusters")), "meeting")
    fixed = F.from_json(F.lit(json.dumps(parameters)), "lag DOUBLE, pure_threshold DOUBLE, screen_threshold DOUBLE, minor_share DOUBLE")
    value = F.struct(F.lit("1.0.0").alias("version"), fixed.withField("voice_clusters", F.col("voice_clusters")).alias("parameters"), "display_names", F.col("l.h").alias("turns"))
    return rows.select("meeting", _json(value).alias("value"))


def stats_files(m: Merged, asr: DataFrame, speakers: DataFrame) -> DataFrame:
    rows = (
        speakers.select("meeting", "stats.*", F.round(F.col("duration") / 60, 1).alias("duration_minutes"))
        .join(at.transcript_stats(m.turns), "meeting")
        .join(asr.select("meeting", F.coalesce("clustered", F.lit(False)).alias("audio_clustering"), F.col("error").alias("clustering_error")), "meeting")
    )
    return rows.select("meeting", _json(F.struct(*[c for c in rows.columns if c != "meeting"])).alias("value"))


def rendered_files(m: Merged, form: str) -> DataFrame:
    return render.FORMATS[form](render.readable(m.turns))
