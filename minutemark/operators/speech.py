"""Transcription with models that the caller brings, a task for each file; what goes wrong with a file is a column."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .attribution import voice_clusters

_SEGMENT = pa.struct([("start", pa.float64()), ("end", pa.float64()), ("text", pa.string())])
_TURN = pa.struct([("start", pa.float64()), ("end", pa.float64()), ("speaker", pa.string())])


def run_models(files: DataFrame, transcriber: Callable[[str], Iterable[tuple]], diarizer: Callable[[str], Iterable[tuple]] | None = None) -> DataFrame:
    """Run the models on (meeting, path): segments, voices, clustered, error, status.

    ``transcriber(path)`` yields (start, end, text), ``diarizer(path)`` (start,
    end, speaker). A failing diarizer leaves the segments, with its message
    in error; a failing transcriber gives status 'failed'.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for meeting, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                segments, voices, clustered, error, status = [], [], False, None, "done"
                try:
                    segments = [{"start": float(a), "end": float(b), "text": t.strip()} for a, b, t in transcriber(path)]
                    if diarizer is not None:
                        try:
                            voices = [{"start": float(a), "end": float(b), "speaker": s} for a, b, s in diarizer(path)]
                            clustered = True
                        except RuntimeError as e:
                            error = str(e)
                except Exception as e:  # the other files go on
                    error, status = f"{type(e).__name__}: {e}", "failed"
                rows.append((meeting, segments, voices, clustered, error, status))
            if rows:
                kinds = [pa.string(), pa.list_(_SEGMENT), pa.list_(_TURN), pa.bool_(), pa.string(), pa.string()]
                names = ["meeting", "segments", "voices", "clustered", "error", "status"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = (
        "meeting string, segments array<struct<start: double, end: double, text: string>>, "
        "voices array<struct<start: double, end: double, speaker: string>>, clustered boolean, error string, status string"
    )
    return files.select(F.col("meeting").cast("string"), "path").mapInArrow(run, schema)


def clustered_segments(ran: DataFrame) -> DataFrame:
    """meeting, seg, s_us, e_us, text, cluster: the voice that overlaps each segment longest, null where voices weren't clustered."""
    us = lambda c: F.bround(c * 1e6, 0).cast("long")
    segments = ran.select("meeting", "clustered", F.posexplode("segments").alias("seg", "s")).select(
        "meeting", F.col("seg").cast("long"), us(F.col("s.start")).alias("s_us"), us(F.col("s.end")).alias("e_us"), F.col("s.text").alias("text"), "clustered"
    )
    voices = ran.select("meeting", F.posexplode("voices").alias("ord", "v")).select(
        "meeting", "ord", us(F.col("v.start")).alias("s_us"), us(F.col("v.end")).alias("e_us"), F.col("v.speaker").alias("speaker")
    )
    named = voice_clusters(segments, voices)
    return named.withColumn("cluster", F.when(F.col("clustered"), F.col("cluster"))).drop("clustered")
