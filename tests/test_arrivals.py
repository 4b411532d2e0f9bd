"""Files that arrive as two streams against the batch joins over all of them."""

import datetime

from minutemark.streaming.arrivals import paired
from minutemark.streaming.changes import run_available

SCHEMA = "meeting string, arrived timestamp"
DAY = datetime.datetime(2024, 5, 1)


def minute(n):
    return DAY + datetime.timedelta(minutes=n)


def test_meetings_are_paired_or_told_as_missing(spark, tmp_path):
    transcripts = [("a", 0), ("b", 5), ("c", 10), ("late", 20), ("d", 30)]
    tracks = [("a", 3), ("c", 65), ("late", 200), ("e", 40), ("d", 30)]
    for name, rows in (("transcripts", transcripts), ("tracks", tracks)):
        for lo in range(0, len(rows), 2):  # several files
            some = [(m, minute(n)) for m, n in rows[lo : lo + 2]]
            spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        spark.createDataFrame([(None, minute(2000))], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    streams = [spark.readStream.schema(SCHEMA).parquet(str(tmp_path / n)) for n in ("transcripts", "tracks")]
    got = run_available(paired(*streams), str(tmp_path / "stream")).collect()
    assert sorted((r.meeting, r.arrived, r.missing or "") for r in got) == sorted(
        [
            ("a", minute(3), ""), ("c", minute(65), ""), ("d", minute(30), ""),
            ("b", minute(5), "speaker track"), ("e", minute(40), "transcript"),
            ("late", minute(20), "speaker track"), ("late", minute(200), "transcript"),
        ]
    )
