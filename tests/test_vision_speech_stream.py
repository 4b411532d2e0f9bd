"""Frames, models and streams on synthetic inputs."""

import numpy as np
import pytest

from minutemark.operators import speech, vision
from minutemark.shared import shared_dir
from minutemark.sources import frames
from minutemark.streaming import changes

GREEN, PALE = (60, 230, 80), (140, 230, 150)


def frame(colour=GREEN, box=(200, 150, 320, 180), thick=4, grey=120, sides="tblr"):
    f = np.full((720, 1280, 3), grey, np.uint8)
    x, y, w, h = box
    if "t" in sides:
        f[y : y + thick, x : x + w] = colour
    if "b" in sides:
        f[y + h - thick : y + h, x : x + w] = colour
    if "l" in sides:
        f[y : y + h, x : x + thick] = colour
    if "r" in sides:
        f[y : y + h, x + w - thick : x + w] = colour
    return f


def found(f):
    return vision.speaker_tile(f)[:3]


def test_rings():
    assert found(frame()) == ((200, 150, 320, 180), "grid", 150)
    assert found(frame(PALE))[1:] == ("grid", 100)
    assert found(frame(sides="tbl"))[1] == "grid"
    assert found(frame(sides="tl"))[1] == "overlay"
    solid = frame()
    solid[150:330, 200:520] = GREEN
    assert found(solid)[1] == "overlay"
    assert found(frame(box=(100, 100, 900, 60)))[1] == "overlay"
    boxed = np.zeros((900, 1280, 3), np.uint8)
    boxed[90:810] = frame()
    assert found(boxed)[0] == (200, 150, 320, 180)
    black = np.zeros((720, 1280, 3), np.uint8)
    assert found(black) == ((1280 - 230, 0, 230, 129), "overlay", None)
    assert vision.annotated(frame(), (10, 10, 50, 50), (1, 2, 3))[10, 20].tolist() == [1, 2, 3]


def test_components_touch_at_corners():
    mask = np.zeros((6, 8), bool)
    mask[0, 0] = mask[1, 1] = mask[2, 0] = mask[5, 5:8] = mask[0, 6] = True
    mask[4, 4] = True
    assert sorted(vision.component_boxes(mask)) == [(0, 0, 2, 3), (4, 4, 4, 2), (6, 0, 1, 1)]


class Fake:
    """Reads the crop's width, and is unsure of small crops."""

    def read(self, crop):
        wide = crop.shape[1] > 200
        return ("Mayor Carol Pritchett" if wide else "Mayor Carol Pritch"), 0.9 if crop.shape[0] > 100 else 0.5, 0.99


def test_reading():
    name, confidence, detection, _ = vision.read_name(frame(), Fake())
    assert (name, confidence, detection) == ("Mayor Carol Pritchett", 0.5, "grid")
    sharper = vision.Escalating(Fake(), vision.enlarge)
    assert sharper.read(np.zeros((40, 50, 3), np.uint8))[1] == 0.9
    assert vision.join_boxes([("Chen", 0.8, 50, 90), ("A.", 0.6, 2, 20), (" ", 1, 0, 1)], 100) == ("A. Chen", 0.7, 0.9)
    with pytest.raises(RuntimeError):
        vision.preflight(type("Blind", (), {"read": lambda self, crop: ("", 0, 0)})(), np.zeros((5, 5, 3), np.uint8))


def test_frames_source(spark, tmp_path):
    np.save(tmp_path / "m1.npy", np.stack([frame() if i < 6 else np.zeros((720, 1280, 3), np.uint8) for i in range(10)]))
    (tmp_path / "m1.npy.fps").write_text("2")
    rows = frames.read_frames(spark, str(tmp_path))
    got = vision.read_frames(rows, Fake()).orderBy("ord").collect()
    assert [(r.meeting, r.ord, r.t_us, r.detection) for r in got] == [("m1", i, i * 500_000, "grid" if i < 6 else "overlay") for i in range(0, 10, 2)]
    assert frames.read_frames(spark, str(tmp_path), start_seconds="1", max_seconds="2").count() == 2


def test_frames_of_several_inputs_in_shards(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / name).mkdir()
        np.save(tmp_path / name / f"{name}.npy", np.zeros((1, 8, 8, 3), np.uint8))
    (tmp_path / "c" / "torn.npy").write_bytes(b"?")
    inputs = [str(tmp_path / "a"), f"file://{tmp_path}/b", str(tmp_path / "c" / "c.npy"), str(tmp_path / "c")]
    rows = frames.read_frames(spark, inputs).collect()
    assert sorted(r.meeting for r in rows) == ["a", "b", "c", "torn"]
    assert [r.meeting for r in rows if r.error] == ["torn"] and all((r.pixels is None) == bool(r.error) for r in rows)
    parts = [{r.meeting for r in frames.read_frames(spark, inputs, shard=f"{i}/2").collect()} for i in range(2)]
    assert parts[0] | parts[1] == {"a", "b", "c", "torn"} and not parts[0] & parts[1]


def test_models(spark):
    def transcriber(path):
        if path == "bad":
            raise ValueError("no audio stream")
        return [(0, 4, " hi "), (4, 8, "there"), (9, 10, "quiet")]

    def diarizer(path):
        if path == "mono":
            raise RuntimeError("gated model")
        return [(0, 2, "S1"), (2, 4, "S0"), (4, 9, "S0")]

    files = spark.createDataFrame([("a", "ok"), ("b", "bad"), ("c", "mono")], "meeting string, path string")
    ran = speech.run_models(files, transcriber, diarizer)
    status = {r.meeting: (r.status, r.clustered, r.error) for r in ran.collect()}
    assert status == {"a": ("done", True, None), "b": ("failed", False, "ValueError: no audio stream"), "c": ("done", False, "gated model")}
    got = {(r.meeting, r.seg): (r.cluster, r.text) for r in speech.clustered_segments(ran).collect()}
    assert got[("a", 0)] == ("S1", "hi") and got[("a", 1)] == ("S0", "there") and got[("a", 2)] == ("unknown", "quiet")
    assert got[("c", 0)] == (None, "hi")


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i % 3, i, i * 10, "ab"[(i // 7) % 2] if i % 5 else None) for i in range(90)]
    schema = "meeting long, ord long, t_us long, name string"
    for part in range(3):
        spark.createDataFrame(rows[part * 30 : part * 30 + 30], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    reads = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = changes.run_available(changes.changes_stream(reads.fillna({"name": "-"})), shared_dir(spark, "stream"))
    from minutemark.operators.intervals import rle_changes

    want = rle_changes(spark.createDataFrame(rows, schema).fillna({"name": "-"}), ["meeting"], ["t_us", "ord"], "name")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("meeting", "ord", "t_us", "name").collect()))
