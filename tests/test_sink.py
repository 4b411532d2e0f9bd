"""The files sink: all files or none, and one file from the pieces of many tasks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from minutemark.plans import clean
from minutemark.sources import sink

from .test_meetings_end_to_end import folder  # noqa: F401  the fixture


def left(path):
    return sorted(os.path.join(d, f).removeprefix(str(path) + "/") for d, _, files in os.walk(path) for f in files)


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    rows = spark.range(40).select(F.concat(F.lit("m"), "id").alias("meeting"), F.concat(F.lit("text "), "id").alias("value"))

    @F.udf("string")
    def broken(meeting):
        if meeting == "m39":
            raise ValueError("the task dies here")
        return meeting

    with pytest.raises(Exception, match="the task dies here"):
        sink.write_named(rows.repartition(4).withColumn("value", broken("meeting")), out, ".txt")
    assert left(tmp_path) == [] and not (tmp_path / "out" / "_drafts").exists()
    assert sink.write_named(rows.repartition(4), out, ".txt") == 40
    assert left(tmp_path) == sorted(f"out/m{i}.txt" for i in range(40))
    # files that are there stay, unless they are to be written anew
    other = rows.limit(3).withColumn("value", F.lit(None).cast("string"))
    assert sink.write_named(other, out, ".txt") == 0 and (tmp_path / "out" / "m0.txt").read_text() == "text 0"
    assert sink.write_named(other, out, ".txt", overwrite=True) == 3 and (tmp_path / "out" / "m0.txt").read_text() == ""
    assert sink.write_named(rows.limit(0), out, ".txt") == 0


def test_pieces_become_one_file_in_order(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    rows = spark.range(5000).select((F.col("id") % 3).cast("int").alias("section"), F.col("id").alias("pos"), F.format_string("%d;", "id").alias("value"))
    assert sink.write_whole(rows.repartition(7), out, "all.txt") == 5000
    assert left(tmp_path) == ["out/all.txt"]
    assert (tmp_path / "out" / "all.txt").read_text() == "".join(f"{i};" for s in range(3) for i in range(s, 5000, 3))


def test_registry_in_parts_says_the_same(spark, folder, tmp_path):  # noqa: F811
    from minutemark.sources import meetings as src

    files = src.read_ocr(spark, [str(folder)])
    done = clean.clean_collection(files, "riverton", ["riverton", "city", "council"])
    parameters = {"variant_threshold": 0.88, "cannot_link_seconds": 5.0, "fill_gap_seconds": 2.0, "no_cross_meeting": False, "context": ["city"]}
    sink.write_whole(clean.registry_parts(done, parameters), f"file://{tmp_path}/out", "registry.json")
    want = json.loads(clean.registry_file(done, parameters).first()["value"])
    assert json.loads((tmp_path / "out" / "registry.json").read_text()) == want and len(want["identities"]) == 2
    told = {r.rule: (r.merged, r.refused) for r in clean.summary(done.evidence).collect()}
    assert sum(m for m, _ in told.values()) == sum(want["merges"].values())
