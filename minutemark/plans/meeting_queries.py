"""Queries of the track and attribution operators on the derived meeting tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import attribution as at
from ..operators import intervals as iv
from ..operators import render, tracks
from ..shared import cut
from . import recipes as r

M = ["meeting"]


def rle_changes(spark: SparkSession, d: str) -> DataFrame:
    reads = r.frame_reads(spark, d)
    return iv.rle_changes(reads, M, ["t_us", "ord"], "name").select("meeting", "ord", "t_us", "name")


def distinct_speakers(spark: SparkSession, d: str) -> DataFrame:
    return iv.first_seen(r.frame_reads(spark, d), M, "ord", "name", "No Speaker")


def frame_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = at.frame_stats(r.frame_reads(spark, d))
    return stats.withColumn("layout", scalars.layout(F.col("frames_grid") / F.col("frames_sampled")))


def dwell_intervals(spark: SparkSession, d: str) -> DataFrame:
    held = iv.dwell_intervals(r.raw_changes(spark, d), M, ["t_us", "ord"], F.lit(r.DURATION_US))
    return held.select("meeting", "ord", "s_us", "e_us", "label")


def _with_other(spark: SparkSession, d: str) -> DataFrame:
    """Dwell intervals of resolved people, devices and gaps as 'Other'."""
    held = dwell_intervals(spark, d)
    person = ~(F.col("label").startswith("iPad") | (F.col("label") == "No Speaker"))
    return held.withColumn("label", F.when(person, F.left(F.replace("label", F.lit("Judge "), F.lit("")), F.lit(4))).otherwise("Other"))


def gap_fill(spark: SparkSession, d: str) -> DataFrame:
    return iv.gap_fill(_with_other(spark, d), M, "label", 5_000_000)


def coalesce_track(spark: SparkSession, d: str) -> DataFrame:
    filled = gap_fill(spark, d).select("meeting", "ord", F.col("s_us").alias("t_us"), "label")
    return iv.coalesce_runs(filled, M, ["t_us"], "label")


def on_screen_time(spark: SparkSession, d: str) -> DataFrame:
    return iv.time_on(r.changes(spark, d), M, ["t_us", "ord"], "label", F.lit(r.DURATION_US))


def overlap_screen_segments(spark: SparkSession, d: str) -> DataFrame:
    return at.screen_overlap(r.segments(spark, d), r.changes(spark, d))


def overlap_by_buckets(spark: SparkSession, d: str) -> DataFrame:
    """The same join with each meeting split by time, for meetings too long for one task."""
    return at.screen_overlap(r.segments(spark, d), r.changes(spark, d), bucket_us=20_000_000)


def cluster_tally(spark: SparkSession, d: str) -> DataFrame:
    return at.cluster_tally(overlap_screen_segments(spark, d))


def cluster_plurality(spark: SparkSession, d: str) -> DataFrame:
    return at.cluster_plurality(cluster_tally(spark, d))


def attribute_segments(spark: SparkSession, d: str) -> DataFrame:
    return at.attribute_segments(r.segments(spark, d), r.changes(spark, d))


def attribute_unclustered(spark: SparkSession, d: str) -> DataFrame:
    """Without voice clusters a meeting's segments are one cluster, null."""
    bare = r.segments(spark, d).withColumn("cluster", F.lit(None).cast("string"))
    return at.attribute_segments(bare, r.changes(spark, d)).drop("cluster")


def merge_turns(spark: SparkSession, d: str) -> DataFrame:
    return at.merge_turns(attribute_segments(spark, d)).drop("clusters", "source")


def turn_provenance(spark: SparkSession, d: str) -> DataFrame:
    turns = at.merge_turns(attribute_segments(spark, d))
    return turns.select("meeting", "turn", "source", F.explode("clusters").alias("cluster", "n_segments"))


def _raw_to_speaker(spark: SparkSession, d: str) -> DataFrame:
    heads = F.array(*[F.lit(n[:2]) for n in r.NAMES])
    person = F.concat(F.lit("p"), (F.array_position(heads, F.left(F.replace("label", F.lit("Judge "), F.lit("")), F.lit(2))) - 1).cast("string"))
    other = F.col("label").startswith("iPad") | (F.col("label") == "No Speaker")
    return r.raw_changes(spark, d).select("meeting", F.col("label").alias("raw"), F.when(other, "Other").otherwise(person).alias("speaker")).distinct()


def raw_to_speaker(spark: SparkSession, d: str) -> DataFrame:
    return _raw_to_speaker(spark, d)


def most_seen_label(spark: SparkSession, d: str) -> DataFrame:
    return at.most_seen_label(at._reads(r.raw_changes(spark, d), _raw_to_speaker(spark, d), r.durations(spark, d), at.LAG_US))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    turns = cut(at.merge_turns(attribute_segments(spark, d)), "turns")
    displays = turns.select("meeting", "speaker", F.upper("speaker").alias("display")).distinct()
    return at.label_turns(turns, r.raw_changes(spark, d), _raw_to_speaker(spark, d), displays, r.durations(spark, d))


def label_turns(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d).select("meeting", "turn", "speaker", "speaker_name", "ocr_label")


def transcript_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = at.transcript_stats(at.merge_turns(attribute_segments(spark, d)))
    return stats.withColumn("speakers", F.array_join("speakers", ","))


def voice_cluster_overlap(spark: SparkSession, d: str) -> DataFrame:
    return at.voice_clusters(r.segments(spark, d), r.voice_turns(spark, d)).select("meeting", "seg", "cluster")


def render_txt(spark: SparkSession, d: str) -> DataFrame:
    return render.to_text(render.readable(_labelled(spark, d)))


def render_srt(spark: SparkSession, d: str) -> DataFrame:
    return render.to_srt(render.readable(_labelled(spark, d)))


def render_vtt(spark: SparkSession, d: str) -> DataFrame:
    return render.to_vtt(render.readable(_labelled(spark, d)))


def long_track(spark: SparkSession, d: str) -> DataFrame:
    """All events as one track: changes, intervals, short errors filled, runs; no task holds the track."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    reads = r.table(spark, d, "events").select("event_id", micros.alias("t_us"), F.col("event_type").alias("label"))
    order = ["t_us", "event_id"]
    held = tracks.to_intervals(tracks.rle_changes(reads, [], order, "label"), [], order, F.col("t_us") + 1_000_000)
    filled = tracks.gap_fill(held, [], "label", 600_000_000, gap="error", order=order)
    return tracks.islands(filled, [], order, "label", "run").select("event_id", "label", "s_us", "e_us", "run")


def meetings_ready(spark: SparkSession, d: str) -> DataFrame:
    """Meetings with both a transcript and a track."""
    return r.segments(spark, d).select("meeting").distinct().join(r.changes(spark, d).select("meeting").distinct(), "meeting")


def meetings_missing_partner(spark: SparkSession, d: str) -> DataFrame:
    """Two tables whose ids differ by themselves: labels stand for transcripts, conversations for tracks."""
    asr = r.table(spark, d, "labels").select(F.col("doc_id").alias("meeting")).distinct()
    track = r.table(spark, d, "conversations").select(F.col("conv_id").alias("meeting")).distinct()
    return asr.join(track, "meeting", "left_anti").withColumn("missing", F.lit("speaker track")).unionByName(
        track.join(asr, "meeting", "left_anti").withColumn("missing", F.lit("transcript"))
    )


def incremental_skip(spark: SparkSession, d: str) -> DataFrame:
    """Conversations whose id has a label are finished; the others are counted by turns."""
    todo = r.table(spark, d, "conversations").withColumnRenamed("conv_id", "meeting")
    done = r.table(spark, d, "labels").select(F.col("doc_id").alias("meeting")).distinct()
    return todo.join(done, "meeting", "left_anti").groupBy("meeting").agg(F.count(F.lit(1)).alias("n"))


def prefer_primary_source(spark: SparkSession, d: str) -> DataFrame:
    """Of a page's two forms the first, by host and path, wins."""
    from ..sources.meetings import prefer_primary

    files = r.table(spark, d, "pages").select(
        F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("meeting"), "page_id", F.col("url").startswith("http:").alias("legacy")
    )
    return prefer_primary(files, "meeting", ["legacy", "page_id"])


def shard_assignment(spark: SparkSession, d: str) -> DataFrame:
    from ..sources.meetings import shard

    return shard(r.table(spark, d, "customer").select("c_name"), "c_name", 2, 5)


S = "SELECT meeting, {} FROM "
_STATS = """SELECT *, round(frames_grid / frames_sampled, 3) AS grid_fraction, round(frames_named / frames_sampled, 3) AS named_fraction,
  CASE WHEN frames_grid / frames_sampled >= 0.8 THEN 'gallery' WHEN frames_grid / frames_sampled >= 0.3 THEN 'mixed' ELSE 'screen-share' END AS layout
FROM (SELECT meeting, count(*) AS frames_sampled, count(*) FILTER (label <> 'No Speaker') AS frames_named,
  count(*) FILTER (detection = 'grid') AS frames_grid, count(*) FILTER (detection = 'overlay') AS frames_overlay FROM raw_changes GROUP BY meeting)"""
_DWELL = """, dwell AS (SELECT * FROM (SELECT meeting, ord, t_us AS s_us,
  coalesce(lead(t_us) OVER (PARTITION BY meeting ORDER BY t_us, ord), greatest(400000000, t_us + 1000000)) AS e_us, label FROM raw_changes) WHERE e_us > s_us)"""
_FILLED = _DWELL + """, others AS (SELECT meeting, ord, s_us, e_us, CASE WHEN label LIKE 'iPad%' OR label = 'No Speaker' THEN 'Other'
  ELSE left(replace(label, 'Judge ', ''), 4) END AS label FROM dwell),
filled AS (SELECT meeting, ord, s_us, e_us, CASE WHEN label = 'Other' AND e_us - s_us <= 5000000 AND lag(label) OVER w = lead(label) OVER w
  AND lag(label) OVER w <> 'Other' THEN lag(label) OVER w ELSE label END AS label FROM others WINDOW w AS (PARTITION BY meeting ORDER BY s_us))"""


def _stamp(us: str, sep: str) -> str:
    ms = f"round_even({us} / 1000, 0)::BIGINT"
    return f"printf('%02d:%02d:%02d{sep}%03d', {ms} // 3600000, {ms} // 60000 % 60, {ms} // 1000 % 60, {ms} % 1000)"


_SAID = "coalesce(speaker_name, 'Other')"

ORACLES = {
    "rle_changes": r.SQL + """SELECT meeting, ord, t_us, label AS name FROM raw_changes
        QUALIFY row_number() OVER (PARTITION BY meeting ORDER BY t_us, ord) = 1 OR label <> lag(label) OVER (PARTITION BY meeting ORDER BY t_us, ord)""",
    "distinct_speakers": r.SQL + "SELECT meeting, label AS name, min(ord) AS first_ord FROM raw_changes WHERE label <> 'No Speaker' GROUP BY ALL",
    "frame_stats": r.SQL + _STATS,
    "dwell_intervals": r.SQL + _DWELL + "SELECT * FROM dwell",
    "gap_fill": r.SQL + _FILLED + "SELECT * FROM filled",
    "coalesce_track": r.SQL + _FILLED + """SELECT meeting, ord, s_us AS t_us, label FROM filled
        QUALIFY row_number() OVER (PARTITION BY meeting ORDER BY s_us) = 1 OR label <> lag(label) OVER (PARTITION BY meeting ORDER BY s_us)""",
    "on_screen_time": r.SQL + """SELECT meeting, label, sum(greatest(0, e_us - t_us))::BIGINT AS us FROM (SELECT meeting, label, t_us,
        coalesce(lead(t_us) OVER (PARTITION BY meeting ORDER BY t_us, ord), 400000000) AS e_us FROM changes) GROUP BY ALL""",
    "overlap_screen_segments": r.ATTRIBUTION_SQL + "SELECT * FROM overlap",
    "overlap_by_buckets": r.ATTRIBUTION_SQL + "SELECT * FROM overlap",
    "cluster_tally": r.ATTRIBUTION_SQL + "SELECT * FROM tally",
    "cluster_plurality": r.ATTRIBUTION_SQL + "SELECT * FROM lead_name",
    "attribute_segments": r.ATTRIBUTION_SQL + "SELECT * FROM named",
    "attribute_unclustered": r.ATTRIBUTION_SQL.replace("role AS cluster", "NULL::VARCHAR AS cluster") + "SELECT * EXCLUDE (cluster) FROM named",
    "merge_turns": r.ATTRIBUTION_SQL + "SELECT * FROM turns",
    "turn_provenance": r.ATTRIBUTION_SQL + """SELECT n.meeting, n.turn, CASE WHEN t.screen_segments > 0 THEN 'screen' ELSE 'cluster' END AS source,
        coalesce(cluster, '') AS cluster, count(*) AS n_segments FROM numbered n JOIN turns t ON n.meeting = t.meeting AND n.turn = t.turn GROUP BY ALL""",
    "raw_to_speaker": r.ATTRIBUTION_SQL + "SELECT * FROM resolved",
    "most_seen_label": r.ATTRIBUTION_SQL + "SELECT * FROM usual",
    "label_turns": r.ATTRIBUTION_SQL + "SELECT meeting, turn, speaker, speaker_name, ocr_label FROM labelled",
    "transcript_stats": r.ATTRIBUTION_SQL + """SELECT meeting, count(*) AS turns, count(*) FILTER (screen_segments > 0) AS turns_named_from_screen,
        string_agg(DISTINCT speaker, ',' ORDER BY speaker) AS speakers FROM turns GROUP BY meeting""",
    "voice_cluster_overlap": r.SQL + """SELECT s.meeting, s.seg, coalesce(b.speaker, 'unknown') AS cluster FROM segments s LEFT JOIN (
        SELECT s.meeting, s.seg, v.speaker FROM segments s JOIN voice_turns v ON s.meeting = v.meeting AND v.s_us < s.e_us AND v.e_us > s.s_us
        WHERE least(s.e_us, v.e_us) > greatest(s.s_us, v.s_us) GROUP BY s.meeting, s.seg, v.speaker QUALIFY row_number() OVER (PARTITION BY s.meeting, s.seg
          ORDER BY sum(least(s.e_us, v.e_us) - greatest(s.s_us, v.s_us)) DESC, min(v.ord)) = 1) b ON s.meeting = b.meeting AND s.seg = b.seg""",
    "render_txt": r.ATTRIBUTION_SQL + f"""SELECT meeting, string_agg('(' || {_stamp('s_us', '.')} || ' - ' || {_stamp('e_us', '.')} || ') ' || {_SAID} || ': ' || trim(text),
        chr(10) || chr(10) ORDER BY turn) AS value FROM labelled GROUP BY meeting""",
    "render_srt": r.ATTRIBUTION_SQL + f"""SELECT meeting, string_agg(n || chr(10) || {_stamp('s_us', ',')} || ' --> ' || {_stamp('e_us', ',')} || chr(10) || {_SAID} || ': ' || trim(text),
        chr(10) || chr(10) ORDER BY turn) || chr(10) AS value FROM (SELECT *, row_number() OVER (PARTITION BY meeting ORDER BY turn) AS n FROM labelled) GROUP BY meeting""",
    "render_vtt": r.ATTRIBUTION_SQL + f"""SELECT meeting, 'WEBVTT' || chr(10) || chr(10) || string_agg({_stamp('s_us', '.')} || ' --> ' || {_stamp('e_us', '.')} || chr(10)
        || '<v ' || {_SAID} || '>' || trim(text) || chr(10), chr(10) ORDER BY turn) AS value FROM labelled GROUP BY meeting""",
    "long_track": """WITH reads AS (SELECT event_id, epoch_us(ts) AS t_us, event_type AS label FROM events),
        changes AS (FROM reads QUALIFY row_number() OVER (ORDER BY t_us, event_id) = 1 OR label IS DISTINCT FROM lag(label) OVER (ORDER BY t_us, event_id)),
        held AS (SELECT *, coalesce(lead(t_us) OVER w, t_us + 1000000) AS e_us, lag(label) OVER w AS b, lead(label) OVER w AS a FROM changes WINDOW w AS (ORDER BY t_us, event_id)),
        filled AS (SELECT event_id, t_us AS s_us, e_us, CASE WHEN label = 'error' AND e_us - t_us <= 600000000 AND b = a AND b <> 'error' THEN b ELSE label END AS label FROM held),
        marked AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 0 ELSE (label IS DISTINCT FROM lag(label) OVER w)::INT END AS new FROM filled WINDOW w AS (ORDER BY s_us, event_id))
        SELECT event_id, label, s_us, e_us, sum(new) OVER (ORDER BY s_us, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM marked""",
    "meetings_ready": r.SQL + "SELECT DISTINCT meeting FROM segments INTERSECT SELECT DISTINCT meeting FROM changes",
    "meetings_missing_partner": """WITH a AS (SELECT DISTINCT doc_id AS meeting FROM labels), t AS (SELECT DISTINCT conv_id AS meeting FROM conversations)
        SELECT meeting, 'speaker track' AS missing FROM a WHERE meeting NOT IN (FROM t) UNION ALL SELECT meeting, 'transcript' AS missing FROM t WHERE meeting NOT IN (FROM a)""",
    "incremental_skip": "SELECT conv_id AS meeting, count(*) AS n FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels) GROUP BY conv_id",
    "prefer_primary_source": """SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS meeting, page_id, url LIKE 'http:%' AS legacy FROM pages
        QUALIFY row_number() OVER (PARTITION BY meeting ORDER BY legacy, page_id) = 1""",
    "shard_assignment": "SELECT c_name FROM customer QUALIFY (row_number() OVER (ORDER BY c_name) - 1) % 5 = 2",
}

QUERIES = {
    f.__name__: f
    for f in (
        rle_changes, distinct_speakers, frame_stats, dwell_intervals, gap_fill, coalesce_track, on_screen_time,
        overlap_screen_segments, overlap_by_buckets, cluster_tally, cluster_plurality, attribute_segments,
        attribute_unclustered, merge_turns, turn_provenance, raw_to_speaker, most_seen_label, label_turns,
        transcript_stats, voice_cluster_overlap, render_txt, render_srt, render_vtt, long_track, meetings_ready,
        meetings_missing_partner, incremental_skip, prefer_primary_source, shard_assignment,
    )
}
