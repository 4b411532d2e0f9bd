"""Meeting files: discovery, JSON sources with declared schemas, and exports of one file for each meeting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import file_id, microseconds
from ..shared import ranked
from .sink import write_named

VIDEO_SUFFIXES = [".mp4", ".mkv", ".webm", ".mov", ".m4v", ".avi"]
AUDIO_SUFFIXES = [".wav", ".mp3", ".m4a", ".flac"]

#: Leftovers of interrupted downloads.
FRAGMENT = r"(?i)\.(f\d+|temp)\.[a-z0-9]+$"

OCR = (
    "video STRING, duration DOUBLE, sampling_rate DOUBLE, super_resolution BOOLEAN, frames_sampled BIGINT, frames_named BIGINT, "
    "frames_grid BIGINT, frames_overlay BIGINT, raw_speaker_changes ARRAY<ARRAY<STRING>>, video_seconds DOUBLE"
)
ASR = "segments ARRAY<STRUCT<start: DOUBLE, end: DOUBLE, text: STRING, speaker: STRING>>, clustered BOOLEAN, error STRING, asr_seconds DOUBLE"
SPEAKERS = (
    "meeting STRING, video STRING, duration DOUBLE, changes ARRAY<ARRAY<STRING>>, raw_changes ARRAY<ARRAY<STRING>>, "
    "raw_to_speaker MAP<STRING,STRING>, speakers MAP<STRING,STRUCT<display: STRING, seconds_on_screen: DOUBLE>>, "
    "stats STRUCT<frames_sampled: BIGINT, frames_named: BIGINT, frames_grid: BIGINT, frames_overlay: BIGINT, grid_fraction: DOUBLE, "
    "named_fraction: DOUBLE, layout: STRING, sampling_rate: DOUBLE>"
)


def discover(spark: SparkSession, path: str | list[str], suffixes: list[str]) -> DataFrame:
    """path, name, meeting of the files given, or in folders given (not below them), whose names end in one of ``suffixes``, whatever their case."""
    files = spark.read.format("binaryFile").load(path).select("path")
    named = files.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    wanted = F.lit(False)
    for s in suffixes:
        wanted |= F.lower("name").endswith(s)
    return named.filter(wanted & ~F.col("name").rlike(FRAGMENT)).withColumn("meeting", file_id(F.col("name")))


def prefer_primary(files: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row of each key: the first by ``order`` (the legacy form last)."""
    w = Window.partitionBy(key).orderBy(*order)
    return files.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def shard(items: DataFrame, order: str, i: int, n: int) -> DataFrame:
    """The items whose place in the order is ``i`` modulo ``n``, from 0.

    Places are counted without one global sort task: see ``ranked``.
    """
    placed = ranked(items, [], [F.col(order)], "shard")
    return placed.filter(F.col("pos") % n == i).select(*items.columns)


def read_json(spark: SparkSession, path: str | list[str], schema: str, suffixes: list[str], legacy: str | None = None) -> DataFrame:
    """One row for each meeting's JSON file, with ``meeting``; of a meeting's two forms the one that isn't legacy."""
    glob = "{" + ",".join("*" + s for s in suffixes) + "}"
    rows = (
        spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", glob).json(path).drop("meeting")
        if "meeting STRING" not in schema
        else spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", glob).json(path)
    )
    rows = rows.withColumn("_file", F.col("_metadata.file_name")).withColumn("meeting", file_id(F.col("_file")))
    if legacy:
        rows = rows.withColumn("_legacy", F.col("_file").endswith(legacy))
        return prefer_primary(rows, "meeting", ["_legacy", "_file"]).drop("_file", "_legacy")
    return rows.drop("_file")


def read_ocr(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_json(spark, path, OCR, [".ocr.json", ".video.json"], legacy=".video.json")


def read_asr(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, ASR, [".asr.json"])


def read_speakers(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, SPEAKERS, [".speakers.json"])


def exploded_changes(files: DataFrame, column: str) -> DataFrame:
    """meeting, ord, t_us, label of a column of [seconds, label] pairs."""
    rows = files.select("meeting", F.posexplode(column).alias("ord", "pair"))
    return rows.select("meeting", F.col("ord").cast("long"), microseconds(F.col("pair")[0]).alias("t_us"), F.col("pair")[1].alias("label"))


def exploded_segments(files: DataFrame) -> DataFrame:
    rows = files.select("meeting", F.posexplode("segments").alias("seg", "s"))
    return rows.select(
        "meeting",
        F.col("seg").cast("long"),
        microseconds(F.col("s.start")).alias("s_us"),
        microseconds(F.col("s.end")).alias("e_us"),
        F.col("s.speaker").alias("cluster"),
        F.coalesce("s.text", F.lit("")).alias("text"),
    )


def pairs_json(changes: DataFrame, label: str, name: str) -> DataFrame:
    """meeting and a JSON array of [seconds, label] pairs, which no Spark type has, as a string."""
    pair = F.concat(F.lit("["), (F.col("t_us") / 1e6).cast("string"), F.lit(", "), F.to_json(F.array(label)).substr(F.lit(2), F.length(F.to_json(F.array(label))) - 2), F.lit("]"))
    rows = changes.select("meeting", F.struct("t_us", "ord", pair.alias("p")).alias("p"))
    return rows.groupBy("meeting").agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("p"))["p"], ", "), F.lit("]")).alias(name))


def export(rows: DataFrame, path: str, suffix: str, overwrite: bool = False) -> int:
    """Write ``value`` of each (meeting, value) to ``path``/<meeting><suffix>; returns how many files were written.

    All files appear or none: see ``sink``. Where a file exists it is left as it is unless ``overwrite``. ``path`` is a
    URI that every executor reaches.
    """
    return write_named(rows, path, suffix, overwrite)


def finished(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """meeting of the outputs ``path``/<meeting><suffix> that are there already, to be anti-joined with what is to be done.

    A folder that isn't there yet has none.
    """
    from pyarrow import fs

    if "://" in path:
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
    name = F.col("name").substr(F.lit(1), F.length("name") - len(suffix))
    return discover(spark, path, [suffix]).select(name.alias("meeting")).distinct()
