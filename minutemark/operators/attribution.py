"""Who says each transcribed segment: voice clusters against the on-screen track.

Tables: segments (meeting, seg, s_us, e_us, cluster or null, text) and changes
(meeting, t_us, label, in the order of t_us and ord). A segment without a
cluster belongs to the meeting's cluster null, which is judged like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut
from . import intervals

#: The highlight moves so long after a voice begins.
LAG_US = 600_000

NO_READ = "No Speaker"

MEETING = ["meeting"]


def screen_overlap(segments: DataFrame, changes: DataFrame, lag_us: int = LAG_US, bucket_us: int | None = None) -> DataFrame:
    """meeting, seg, cluster, name, us: how long each name was on screen during each segment.

    ``bucket_us`` takes the join by stretches of so long in place of the sweep.
    """
    track = intervals.to_intervals(changes, MEETING, ["t_us", "ord"], lag_us=lag_us).select(
        "meeting", "s_us", "e_us", F.col("label").alias("name")
    )
    spoken = segments.select("meeting", "seg", "cluster", "s_us", "e_us")
    pairs = intervals.overlap_join_by_buckets(spoken, track, MEETING, bucket_us) if bucket_us else intervals.overlap_join(spoken, track, MEETING)
    return pairs.groupBy("meeting", "seg", "cluster", "name").agg(F.sum("us").alias("us"))


def cluster_tally(overlap: DataFrame) -> DataFrame:
    """meeting, cluster, name, us, and the cluster's total."""
    tally = overlap.groupBy("meeting", "cluster", "name").agg(F.sum("us").alias("us"))
    return tally.withColumn("total_us", F.sum("us").over(Window.partitionBy("meeting", "cluster")))


def cluster_plurality(tally: DataFrame) -> DataFrame:
    """Each cluster's leading name and its share; of equal names the smallest."""
    return intervals.top_by(tally, ["meeting", "cluster"], "us", "name").select(
        "meeting", "cluster", F.col("name").alias("cluster_name"), (F.col("us") / F.col("total_us")).alias("cluster_share")
    )


def attribute_segments(
    segments: DataFrame,
    changes: DataFrame,
    lag_us: int = LAG_US,
    pure: float = 0.8,
    screen: float = 0.7,
    minor: float = 0.1,
) -> DataFrame:
    """Segments with speaker, source ('cluster' or 'screen') and screen_share.

    A segment gets its cluster's leading name ('Other' if the cluster was never
    on screen). In a cluster whose leading share is under ``pure``, a segment whose own leading
    name, not 'Other', covers at least ``screen`` of it and holds at least ``minor`` of the
    cluster gets that name instead.
    """
    overlap = cut(screen_overlap(segments, changes, lag_us), "overlap")
    tally = cluster_tally(overlap)
    leading = cluster_plurality(tally)
    own = intervals.top_by(overlap, ["meeting", "seg"], "us", "name").select(
        "meeting", "seg", F.col("name").alias("top"), F.col("us").alias("top_us")
    )
    shares = tally.select(
        F.col("meeting").alias("_m"), F.col("cluster").alias("_c"), F.col("name").alias("_n"), (F.col("us") / F.col("total_us")).alias("top_held")
    )
    lead = leading.select(F.col("meeting").alias("_lm"), F.col("cluster").alias("_lc"), "cluster_name", "cluster_share")
    rows = segments.join(own, ["meeting", "seg"], "left")
    rows = rows.join(lead, (rows["meeting"] == F.col("_lm")) & rows["cluster"].eqNullSafe(F.col("_lc")), "left")
    rows = rows.join(
        shares, (rows["meeting"] == F.col("_m")) & rows["cluster"].eqNullSafe(F.col("_c")) & (rows["top"] == F.col("_n")), "left"
    )
    length = F.greatest(F.col("e_us") - F.col("s_us"), F.lit(1))
    name = F.coalesce("cluster_name", F.lit("Other"))
    by_screen = (
        (F.coalesce("cluster_share", F.lit(1.0)) < pure)
        & (F.col("top") != "Other")
        & (F.col("top") != name)
        & (F.col("top_us") / length >= screen)
        & (F.col("top_held") >= minor)
    )
    rows = rows.withColumn("_by_screen", F.coalesce(by_screen, F.lit(False))).withColumn(
        "speaker", F.when(F.col("_by_screen"), F.col("top")).otherwise(name)
    )
    chosen = overlap.select("meeting", "seg", F.col("name").alias("speaker"), F.col("us").alias("covered_us"))
    rows = rows.join(chosen, ["meeting", "seg", "speaker"], "left")
    return rows.select(
        *segments.columns,
        "speaker",
        F.when(F.col("_by_screen"), "screen").otherwise("cluster").alias("source"),
        F.round(F.coalesce("covered_us", F.lit(0)) / length, 3).alias("screen_share"),
    )


def merge_turns(segments: DataFrame) -> DataFrame:
    """Runs of segments with one speaker, with where each turn's name comes from.

    meeting, turn (from 0), s_us, e_us (of its last segment), speaker, text,
    segments, screen_segments, screen_share, source, clusters (map of cluster, null as '', to number of segments).
    """
    numbered = intervals.islands(segments, MEETING, ["seg"], "speaker", "turn")
    by_turn = ["meeting", "turn"]
    words = F.array_sort(F.collect_list(F.struct("seg", F.btrim("text", F.lit(" \t\r\n")).alias("text"))))
    turns = numbered.groupBy(*by_turn).agg(
        F.min_by("s_us", "seg").alias("s_us"),
        F.max_by("e_us", "seg").alias("e_us"),
        F.first("speaker").alias("speaker"),
        F.btrim(F.array_join(words["text"], " ")).alias("text"),
        F.count(F.lit(1)).alias("segments"),
        F.count_if(F.col("source") == "screen").alias("screen_segments"),
        F.sum(F.col("screen_share").cast("decimal(12,3)") * (F.col("e_us") - F.col("s_us"))).alias("_covered"),
    )
    heard = numbered.groupBy(*by_turn, F.coalesce("cluster", F.lit("")).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    heard = heard.groupBy(*by_turn).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", "n")))).alias("clusters"))
    return (
        turns.join(heard, by_turn)
        .withColumn("screen_share", F.round(F.col("_covered").cast("double") / F.greatest(F.col("e_us") - F.col("s_us"), F.lit(1)), 3))
        .withColumn("source", F.when(F.col("screen_segments") > 0, "screen").otherwise("cluster"))
        .drop("_covered")
    )


def _reads(raw_changes: DataFrame, raw_to_speaker: DataFrame, durations: DataFrame, lag_us: int) -> DataFrame:
    """Raw reads as intervals, with the speaker that each became ('Other' if unknown)."""
    rows = raw_changes.join(durations, "meeting")
    held = intervals.to_intervals(rows, MEETING, ["t_us", "label"], F.col("duration_us"), lag_us).filter(F.col("label") != NO_READ)
    known = raw_to_speaker.select("meeting", F.col("raw").alias("label"), F.col("speaker").alias("resolved"))
    return held.join(known, ["meeting", "label"], "left").select(
        "meeting", "label", "s_us", "e_us", F.coalesce("resolved", F.lit("Other")).alias("resolved")
    )


def most_seen_label(reads: DataFrame) -> DataFrame:
    """Each speaker's raw label that was on screen longest."""
    total = reads.groupBy("meeting", "resolved", "label").agg(F.sum(F.col("e_us") - F.col("s_us")).alias("us"))
    return intervals.top_by(total, ["meeting", "resolved"], "us", "label")


def label_turns(
    turns: DataFrame,
    raw_changes: DataFrame,
    raw_to_speaker: DataFrame,
    displays: DataFrame,
    durations: DataFrame,
    lag_us: int = LAG_US,
) -> DataFrame:
    """Turns with speaker_name and ocr_label.

    Of the raw reads that became the turn's speaker, the one longest on screen
    during the turn; if none was, the speaker's longest in the meeting, but nothing for
    'Other'. Tables: raw_changes (meeting, t_us, label), raw_to_speaker (meeting,
    raw, speaker), displays (meeting, speaker, display), durations (meeting, duration_us).
    """
    reads = _reads(raw_changes, raw_to_speaker, durations, lag_us)
    spoken = turns.select("meeting", "turn", "s_us", "e_us", F.col("speaker").alias("resolved"))
    during = intervals.overlap_join(spoken, reads, ["meeting", "resolved"]).groupBy("meeting", "turn", "label").agg(F.sum("us").alias("us"))
    best = intervals.top_by(during, ["meeting", "turn"], "us", "label").select("meeting", "turn", F.col("label").alias("_now"))
    usual = most_seen_label(reads).select("meeting", F.col("resolved").alias("speaker"), F.col("label").alias("_usual"))
    rows = turns.join(best, ["meeting", "turn"], "left").join(usual, ["meeting", "speaker"], "left")
    rows = rows.join(displays.select("meeting", "speaker", "display"), ["meeting", "speaker"], "left")
    other = F.col("speaker") == "Other"
    return rows.select(
        *turns.columns,
        F.when(~other, F.coalesce("display", "speaker")).alias("speaker_name"),
        F.coalesce("_now", F.when(~other, F.col("_usual"))).alias("ocr_label"),
    )


def voice_clusters(segments: DataFrame, voice_turns: DataFrame) -> DataFrame:
    """Name each segment's voice: the voice speaker that overlaps it longest, 'unknown' where none does.

    Of equal ones the first in the order of the voice turns wins. voice_turns:
    meeting, ord, s_us, e_us, speaker.
    """
    pairs = intervals.overlap_join(segments.select("meeting", "seg", "s_us", "e_us"), voice_turns.select("meeting", "ord", "s_us", "e_us", "speaker"), MEETING)
    heard = pairs.groupBy("meeting", "seg", "speaker").agg(F.sum("us").alias("us"), F.min("ord").alias("first_ord"))
    best = intervals.top_by(heard, ["meeting", "seg"], "us", "first_ord").select("meeting", "seg", F.col("speaker").alias("_voice"))
    return segments.drop("cluster").join(best, ["meeting", "seg"], "left").withColumn("cluster", F.coalesce("_voice", F.lit("unknown"))).drop("_voice")


def transcript_stats(turns: DataFrame) -> DataFrame:
    return turns.groupBy("meeting").agg(
        F.count(F.lit(1)).alias("turns"),
        F.count_if(F.col("source") == "screen").alias("turns_named_from_screen"),
        F.sort_array(F.collect_set("speaker")).alias("speakers"),
    )


def frame_stats(reads: DataFrame) -> DataFrame:
    """Counters of a meeting's sampled frames; overlay counts every overlay detection, named or not."""
    counted = reads.groupBy("meeting").agg(
        F.count(F.lit(1)).alias("frames_sampled"),
        F.count_if(F.col("name") != NO_READ).alias("frames_named"),
        F.count_if(F.col("detection") == "grid").alias("frames_grid"),
        F.count_if(F.col("detection") == "overlay").alias("frames_overlay"),
    )
    share = lambda c: F.round(F.col(c) / F.greatest(F.col("frames_sampled"), F.lit(1)), 3)
    return counted.withColumns({"grid_fraction": share("frames_grid"), "named_fraction": share("frames_named")})
