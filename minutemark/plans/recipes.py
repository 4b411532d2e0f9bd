"""Meeting tables derived from the star-schema tables, the same way in Spark and in SQL.

conversations become transcribed segments, events an on-screen track, part names people.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that the events' users get, and how long each meeting lasts.
NAMES = ["Alice Chen", "Adam Chen", "Wade Hedtke", "Pat Benavides", "Irma Kasting"]
DURATION_US = 400_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """meeting, seg, s_us, e_us, cluster, text: about 15 characters a second, a turn after the other."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("meeting"),
        F.col("turn").cast("long").alias("seg"),
        F.col("role").alias("cluster"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    length = F.length("text").cast("long") * 66667
    ends = F.sum(length).over(Window.partitionBy("meeting").orderBy("seg").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("e_us", ends).withColumn("s_us", F.col("e_us") - length)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    meetings = table(spark, sf_dir, "conversations").agg(F.countDistinct("conv_id").alias("_n"))  # one row
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - 1_704_067_200_000_000
    return table(spark, sf_dir, "events").join(F.broadcast(meetings)).select(
        (F.col("event_id") % F.col("_n")).alias("meeting"),
        F.col("event_id").alias("ord"),
        F.floor(micros / 6480).cast("long").alias("t_us"),
        "user_id",
        "event_type",
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """meeting, ord, t_us, label: a clean track of five people."""
    return _events(spark, sf_dir).select(
        "meeting", "ord", "t_us", F.concat(F.lit("p"), (F.col("user_id") % 5).cast("string")).alias("label")
    )


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """meeting, ord, t_us, label: labels as read, plain, clipped, titled, of devices or none."""
    name = F.element_at(F.array(*[F.lit(n) for n in NAMES]), (F.col("user_id") % 5 + 1).cast("int"))
    label = (
        F.when(F.col("event_type") == "view", name)
        .when(F.col("event_type") == "click", F.concat(F.left(name, F.length(name) - 2), F.lit("..")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("Judge "), name))
        .when(F.col("event_type") == "signup", "No Speaker")
        .otherwise(F.concat(F.lit("iPad "), (F.col("user_id") % 5).cast("string")))
    )
    return _events(spark, sf_dir).select("meeting", "ord", "t_us", label.alias("label"))


def frame_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """meeting, ord, t_us, name, detection: one sampled frame for each event."""
    detection = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "signup", "overlay").otherwise("grid")
    kinds = _events(spark, sf_dir).select("meeting", "ord", detection.alias("detection"))
    return raw_changes(spark, sf_dir).withColumnRenamed("label", "name").join(kinds, ["meeting", "ord"])


def voice_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """meeting, ord, s_us, e_us, speaker: a coarser track that holds each voice until the next."""
    from ..operators.intervals import to_intervals

    bought = _events(spark, sf_dir).filter("event_type = 'purchase'")
    voices = bought.select("meeting", "ord", "t_us", F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("speaker"))
    return to_intervals(voices, ["meeting"], ["t_us", "ord"], DURATION_US).drop("t_us")


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("meeting").distinct().withColumn("duration_us", F.lit(DURATION_US).cast("long"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scope, meeting, name, us, truncated, title: sightings of two-word names, some with their spelling spoilt."""
    clean = F.col("p_name")
    spoilt = (
        F.when(F.col("p_partkey") % 7 == 0, F.left(clean, F.length(clean) - 2))
        .when(F.col("p_partkey") % 7 == 1, F.translate(clean, "il", "li"))
        .when(F.col("p_partkey") % 7 == 2, F.concat(F.left(clean, F.lit(1)), F.lit(" "), F.element_at(F.split(clean, " "), -1)))
        .otherwise(clean)
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("c"), (F.col("p_partkey") % 3).cast("string")).alias("scope"),
        (F.col("p_partkey") % 20).alias("meeting"),
        spoilt.alias("name"),
        (F.col("p_size").cast("long") * 1_000_000).alias("us"),
        (F.col("p_partkey") % 7 == 0).alias("truncated"),
        F.when(F.col("p_partkey") % 11 == 0, "judge").alias("title"),
    )


_NAME = f"list_extract({NAMES}, (user_id % 5 + 1)::INT)"

#: The same tables as SQL common table expressions, to be put before a query.
SQL = f"""
WITH segments AS (
  SELECT conv_id AS meeting, turn::BIGINT AS seg, role AS cluster, coalesce(text, '') AS text,
         (sum(length(coalesce(text, '')) * 66667) OVER w)::BIGINT AS e_us,
         (sum(length(coalesce(text, '')) * 66667) OVER w)::BIGINT - length(coalesce(text, '')) * 66667 AS s_us
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)),
ev AS (
  SELECT event_id % (SELECT count(DISTINCT conv_id) FROM conversations) AS meeting, event_id AS ord,
         (epoch_us(ts) - 1704067200000000) // 6480 AS t_us, user_id, event_type FROM events),
changes AS (SELECT meeting, ord, t_us, 'p' || (user_id % 5) AS label FROM ev),
raw_changes AS (
  SELECT meeting, ord, t_us,
         CASE event_type WHEN 'view' THEN {_NAME}
           WHEN 'click' THEN left({_NAME}, length({_NAME}) - 2) || '..'
           WHEN 'purchase' THEN 'Judge ' || {_NAME}
           WHEN 'signup' THEN 'No Speaker' ELSE 'iPad ' || (user_id % 5) END AS label,
         CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'overlay' ELSE 'grid' END AS detection
  FROM ev),
voice_turns AS (
  SELECT meeting, ord, t_us AS s_us, coalesce(lead(t_us) OVER (PARTITION BY meeting ORDER BY t_us, ord), {DURATION_US}) AS e_us,
         'v' || (user_id % 3) AS speaker
  FROM ev WHERE event_type = 'purchase'),
people AS (
  SELECT 'c' || (p_partkey % 3) AS scope, p_partkey % 20 AS meeting,
         CASE p_partkey % 7 WHEN 0 THEN left(p_name, length(p_name) - 2) WHEN 1 THEN translate(p_name, 'il', 'li')
           WHEN 2 THEN left(p_name, 1) || ' ' || split_part(p_name, ' ', -1) ELSE p_name END AS name,
         p_size::BIGINT * 1000000 AS us, p_partkey % 7 = 0 AS truncated,
         CASE WHEN p_partkey % 11 = 0 THEN 'judge' END AS title
  FROM part)
"""

#: On top of these: the track moved back by the lag, its overlap with the segments and what follows from it.
ATTRIBUTION_SQL = SQL + """,
track AS (
  SELECT meeting, label AS name, t_us - 600000 AS s_us,
         coalesce(lead(t_us) OVER (PARTITION BY meeting ORDER BY t_us, ord), 4611686018427387904) - 600000 AS e_us FROM changes),
pairs AS (
  SELECT s.meeting, s.seg, s.cluster, t.name, least(s.e_us, t.e_us) - greatest(s.s_us, t.s_us) AS us
  FROM segments s JOIN track t ON s.meeting = t.meeting AND t.s_us < s.e_us AND t.e_us > s.s_us),
overlap AS (SELECT meeting, seg, cluster, name, sum(us)::BIGINT AS us FROM pairs WHERE us > 0 GROUP BY ALL),
tally AS (
  SELECT *, (sum(us) OVER (PARTITION BY meeting, cluster))::BIGINT AS total_us
  FROM (SELECT meeting, cluster, name, sum(us)::BIGINT AS us FROM overlap GROUP BY ALL)),
lead_name AS (
  SELECT meeting, cluster, name AS cluster_name, us / total_us AS cluster_share FROM tally
  QUALIFY row_number() OVER (PARTITION BY meeting, cluster ORDER BY us DESC, name) = 1),
own AS (SELECT meeting, seg, name AS top, us AS top_us FROM overlap
  QUALIFY row_number() OVER (PARTITION BY meeting, seg ORDER BY us DESC, name) = 1),
decided AS (
  SELECT s.*, coalesce(coalesce(cluster_share, 1) < 0.8 AND top <> 'Other' AND top <> coalesce(cluster_name, 'Other')
           AND top_us / greatest(e_us - s_us, 1) >= 0.7 AND t.us / t.total_us >= 0.1, false) AS by_screen,
         CASE WHEN by_screen THEN top ELSE coalesce(cluster_name, 'Other') END AS speaker
  FROM segments s LEFT JOIN own o ON s.meeting = o.meeting AND s.seg = o.seg
  LEFT JOIN lead_name l ON s.meeting = l.meeting AND s.cluster IS NOT DISTINCT FROM l.cluster
  LEFT JOIN tally t ON s.meeting = t.meeting AND s.cluster IS NOT DISTINCT FROM t.cluster AND o.top = t.name),
named AS (
  SELECT d.meeting, d.seg, d.s_us, d.e_us, d.cluster, d.text, d.speaker,
         CASE WHEN by_screen THEN 'screen' ELSE 'cluster' END AS source,
         round(coalesce(o.us, 0) / greatest(d.e_us - d.s_us, 1), 3) AS screen_share
  FROM decided d LEFT JOIN overlap o ON d.meeting = o.meeting AND d.seg = o.seg AND d.speaker = o.name),
numbered AS (
  SELECT *, sum(new) OVER (PARTITION BY meeting ORDER BY seg ROWS UNBOUNDED PRECEDING)::BIGINT AS turn FROM (
    SELECT *, CASE WHEN lag(speaker) OVER w = speaker OR row_number() OVER w = 1 THEN 0 ELSE 1 END AS new
    FROM named WINDOW w AS (PARTITION BY meeting ORDER BY seg))),
turns AS (
  SELECT meeting, turn, arg_min(s_us, seg) AS s_us, arg_max(e_us, seg) AS e_us, any_value(speaker) AS speaker,
         trim(string_agg(trim(text, ' \t\r\n'), ' ' ORDER BY seg)) AS text, count(*) AS segments,
         count(*) FILTER (source = 'screen') AS screen_segments,
         round(sum(screen_share::DECIMAL(12,3) * (e_us - s_us))::DOUBLE / greatest(arg_max(e_us, seg) - arg_min(s_us, seg), 1), 3) AS screen_share
  FROM numbered GROUP BY meeting, turn),
resolved AS (
  SELECT DISTINCT meeting, label AS raw,
         CASE WHEN label LIKE 'iPad%' OR label = 'No Speaker' THEN 'Other'
              ELSE 'p' || (list_position(['Al', 'Ad', 'Wa', 'Pa', 'Ir'], left(replace(label, 'Judge ', ''), 2)) - 1) END AS speaker
  FROM raw_changes),
reads AS (
  SELECT i.meeting, i.label, i.s_us, i.e_us, coalesce(r.speaker, 'Other') AS resolved FROM (
    SELECT meeting, label, t_us - 600000 AS s_us,
           coalesce(lead(t_us) OVER (PARTITION BY meeting ORDER BY t_us, label), 400000000) - 600000 AS e_us FROM raw_changes) i
  LEFT JOIN resolved r ON i.meeting = r.meeting AND i.label = r.raw WHERE i.label <> 'No Speaker'),
usual AS (
  SELECT meeting, resolved, label, sum(e_us - s_us)::BIGINT AS us FROM reads GROUP BY meeting, resolved, label
  QUALIFY row_number() OVER (PARTITION BY meeting, resolved ORDER BY sum(e_us - s_us) DESC, label) = 1),
seen AS (
  SELECT t.meeting, t.turn, r.label FROM turns t JOIN reads r ON t.meeting = r.meeting AND t.speaker = r.resolved
    AND r.s_us < t.e_us AND r.e_us > t.s_us
  WHERE least(t.e_us, r.e_us) > greatest(t.s_us, r.s_us) GROUP BY t.meeting, t.turn, r.label
  QUALIFY row_number() OVER (PARTITION BY t.meeting, t.turn
    ORDER BY sum(least(t.e_us, r.e_us) - greatest(t.s_us, r.s_us)) DESC, r.label) = 1),
labelled AS (
  SELECT t.*, CASE WHEN t.speaker <> 'Other' THEN upper(t.speaker) END AS speaker_name,
         coalesce(s.label, CASE WHEN t.speaker <> 'Other' THEN u.label END) AS ocr_label
  FROM turns t LEFT JOIN seen s ON t.meeting = s.meeting AND t.turn = s.turn
  LEFT JOIN usual u ON t.meeting = u.meeting AND t.speaker = u.resolved)
"""
