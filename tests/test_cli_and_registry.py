"""The command line's steps in order, and the driver's registry."""

import json

import numpy as np

import __spark_entry__
from minutemark import cli


class Reader:
    def read(self, crop):
        return ("Susan Gross" if crop.mean() < 200 else ""), 0.95, 0.5


READER = Reader()


def words(path):
    with open("/" + path.removeprefix("file:").lstrip("/") + ".heard", "a") as tally:
        tally.write("x")
    return [(0, 3, "good evening"), (3, 5, "thank you")]


def voices(path):
    return [(0, 5, "S0")]


def test_steps(spark, tmp_path, capsys):
    from tests.test_vision_speech_stream import frame

    np.save(tmp_path / "m1.npy", np.stack([frame()] * 6))
    (tmp_path / "m1.npy.fps").write_text("1")
    (tmp_path / "m1.wav").write_bytes(b"x")
    work, out = str(tmp_path / "river_city"), str(tmp_path / "out")
    here = "tests.test_cli_and_registry"
    assert cli.main(["read-frames", str(tmp_path), "--out", work, "--reader", f"{here}:READER"]) == 0
    body = json.loads((tmp_path / "river_city" / "m1.ocr.json").read_text())
    assert body["frames_grid"] == 6 and body["raw_speaker_changes"] == [[0.0, "Susan Gross"]]
    assert cli.main(["transcribe", str(tmp_path), "--out", work, "--transcriber", f"{here}:words", "--clustering", "on"]) == 2
    assert cli.main(["transcribe", str(tmp_path), "--out", work, "--transcriber", f"{here}:words", "--diarizer", f"{here}:voices"]) == 0
    assert cli.main(["clean", work, "--out", work]) == 0
    assert cli.main(["merge", "--asr", work, "--speakers", work, "--out", out, "--formats", "pdf"]) == 2
    assert cli.main(["merge", "--asr", work, "--speakers", work, "--out", out, "--formats", "json,srt"]) == 0
    (turn,) = json.loads((tmp_path / "out" / "m1.json").read_text())
    assert (turn["speaker_name"], turn["text"], turn["end"]) == ("Susan Gross", "good evening thank you", 5.0)
    assert (tmp_path / "out" / "m1.srt").exists()
    # A second run opens no video and hears no recording again, and merges only what lacks a form.
    (tmp_path / "m1.npy").write_bytes(b"broken")
    assert cli.main(["read-frames", str(tmp_path), "--out", work, "--reader", f"{here}:READER"]) == 0
    heard = len((tmp_path / "m1.wav.heard").read_text())
    assert cli.main(["transcribe", str(tmp_path), "--out", work, "--transcriber", f"{here}:words"]) == 0
    assert len((tmp_path / "m1.wav.heard").read_text()) == heard
    assert cli.main(["merge", "--asr", work, "--speakers", work, "--out", out, "--formats", "json,srt"]) == 0
    assert cli.main(["merge", "--asr", work, "--speakers", work, "--out", out, "--formats", "json,vtt"]) == 0
    assert (tmp_path / "out" / "m1.vtt").exists()


def test_registry_is_consistent(spark):
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 40
    assert __spark_entry__.entry(spark).count() > 0


def test_a_bad_video_is_counted_and_tried_again(spark, tmp_path, capsys):
    from tests.test_vision_speech_stream import frame

    one, two, work = tmp_path / "one", tmp_path / "two", str(tmp_path / "work")
    one.mkdir(), two.mkdir()
    np.save(one / "good.npy", np.stack([frame()] * 3))
    np.save(two / "more.npy", np.stack([frame()] * 3))
    (two / "bad.npy").write_bytes(b"broken")
    step = ["read-frames", str(one), str(two), "--out", work, "--reader", "tests.test_cli_and_registry:READER"]
    assert cli.main(step) == 1
    assert sorted(p.name for p in (tmp_path / "work").iterdir()) == ["good.ocr.json", "more.ocr.json"]
    assert "1 video(s) could not be read" in capsys.readouterr().out
    np.save(two / "bad.npy", np.stack([frame()] * 3))
    assert cli.main(step) == 0 and (tmp_path / "work" / "bad.ocr.json").exists()


def test_given_names_from_a_file(spark, tmp_path):
    (tmp_path / "names.txt").write_text("Zoë\n\nAda\nada\n")
    assert cli._given_names(spark, str(tmp_path / "names.txt")) == ["ada", "zoe"]
