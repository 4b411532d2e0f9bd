"""Files in, files out: cleaning a small collection and merging it with transcripts."""

import json

import pytest

from minutemark.plans import clean, merge
from minutemark.sources import meetings as src

TRACKS = {
    "m1": [[0, "Susan Gross - Pro.."], [5, "Susan Gross - Pro..."], [9, "No Speaker"], [10, "Susan Gross"], [20, "Appellant - John Wall"], [30, "iPad (7)"]],
    "m2": [[0.0, "Judge Susan Gross"], [15, "John Wail"], [21, "Council Chambers"], [25, "Judge Susan Gros.."]],
    "m3": [],
}
SPEECH = {
    "m1": [(0, 8, "S0", " Hello "), (8, 19, "S0", "again"), (21, 29, "S1", "my turn"), (31, 35, None, "static")],
    "m2": [(0, 10, "S0", "order"), (16, 20, "S1", "yes")],
    "m9": [(0, 1, None, "lost")],
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("riverton_city_council")
    for name, track in TRACKS.items():
        body = {"video": f"{name}.mp4", "duration": 40.0, "sampling_rate": 1.0, "frames_sampled": 40, "frames_named": 30, "frames_grid": 35, "frames_overlay": 5, "raw_speaker_changes": track}
        (path / f"{name}.ocr.json").write_text(json.dumps(body))
    (path / "m1.video.json").write_text(json.dumps({"duration": 1.0, "raw_speaker_changes": [[0, "Old Form"]]}))
    for name, segments in SPEECH.items():
        rows = [{"start": a, "end": b, "text": t, **({"speaker": s} if s else {})} for a, b, s, t in segments]
        (path / f"{name}.asr.json").write_text(json.dumps({"segments": rows, "clustered": name == "m1", "error": None, "asr_seconds": 1.5}))
    return path


def test_clean_and_merge(spark, folder, tmp_path):
    files = src.read_ocr(spark, str(folder))
    assert {r.meeting for r in files.collect()} == set(TRACKS)
    done = clean.clean_collection(files, "riverton", ["riverton", "city", "council"])
    track = {}
    for r in done.tracks.orderBy("meeting", "t_us").collect():
        track.setdefault(r.meeting, []).append((r.t_us / 1e6, r.label))
    assert track["m1"] == [(0.0, "susangross"), (20.0, "johnwall"), (30.0, "Other")]
    assert track["m2"] == [(0.0, "susangross"), (15.0, "johnwall"), (21.0, "Other"), (25.0, "susangross")]
    people = {r.speaker: r for r in done.identities.collect()}
    assert set(people) == {"susangross", "johnwall"}
    assert people["susangross"].display == "Judge Susan Gross" and people["susangross"].meetings == 2
    assert people["susangross"].us == 50_000_000 - 1_000_000  # 5 + 4 + 10 and 15 + 15 seconds as read
    assert people["johnwall"].roles == ["appellant"]
    assert dict(done.kinds.collect()) == {"person": 7, "noise": 1, "device": 1, "role": 1}

    out = f"file://{tmp_path}/work"
    assert src.export(clean.speakers_files(files, done), out, ".speakers.json") == 3
    body = json.loads((tmp_path / "work" / "m1.speakers.json").read_text())
    assert body["changes"] == [[0.0, "susangross"], [20.0, "johnwall"], [30.0, "Other"]]
    assert body["raw_changes"][2] == [9.0, "No Speaker"] and body["stats"]["layout"] == "gallery"
    assert body["speakers"]["susangross"] == {"display": "Judge Susan Gross", "seconds_on_screen": 20.0}
    assert body["raw_to_speaker"]["iPad (7)"] == "Other"
    parameters = {"variant_threshold": 0.88, "cannot_link_seconds": 5.0, "fill_gap_seconds": 2.0, "no_cross_meeting": False, "context": ["city"]}
    src.export(clean.registry_file(done, parameters), out, ".json")
    registry = json.loads((tmp_path / "work" / "registry.json").read_text())
    assert registry["identities"][0]["speaker"] == "susangross" and registry["meetings"] == ["m1", "m2", "m3"]
    assert registry["parameters"]["context"] == ["city"]

    asr, speakers = src.read_asr(spark, str(folder)), src.read_speakers(spark, f"{tmp_path}/work")
    merged = merge.merge_meetings(asr, speakers)
    assert {(r.meeting, r.missing) for r in merged.missing.collect()} == {("m3", "transcript"), ("m9", "speaker track")}
    turns = [(r.meeting, r.turn, r.speaker, r.speaker_name, r.ocr_label, r.text) for r in merged.turns.orderBy("meeting", "turn").collect()]
    assert turns[0] == ("m1", 0, "susangross", "Judge Susan Gross", "Susan Gross", "Hello again")
    assert turns[1][2:5] == ("johnwall", "John Wall", "Appellant - John Wall")
    assert turns[2] == ("m1", 2, "Other", None, "iPad (7)", "static")
    for rows, suffix in (
        (merge.transcript_files(merged), ".json"),
        (merge.attribution_files(merged, asr, {"lag": 0.6, "pure_threshold": 0.8, "screen_threshold": 0.7, "minor_share": 0.1}), ".attribution.json"),
        (merge.stats_files(merged, asr, speakers), ".stats.json"),
        *((merge.rendered_files(merged, f), f".{f}") for f in ("txt", "srt", "vtt")),
    ):
        assert src.export(rows, f"file://{tmp_path}/out", suffix) == 2
        assert src.export(rows, f"file://{tmp_path}/out", suffix) == 0  # finished files stay
    stats = json.loads((tmp_path / "out" / "m1.stats.json").read_text())
    assert stats["turns"] == 3 and stats["audio_clustering"] is True and "clustering_error" in stats
    how = json.loads((tmp_path / "out" / "m1.attribution.json").read_text())
    assert how["turns"][0]["clusters"] == {"S0": 2} and how["parameters"]["voice_clusters"] is True
    assert (tmp_path / "out" / "m1.txt").read_text().startswith("(00:00:00.000 - 00:00:19.000) Judge Susan Gross: Hello again\n\n")
    assert (tmp_path / "out" / "m1.srt").read_text().startswith("1\n00:00:00,000 --> 00:00:19,000\n")
    assert (tmp_path / "out" / "m1.vtt").read_text().startswith("WEBVTT\n\n00:00:00.000 --> ")
    again = merge.merge_meetings(asr, speakers, done=src.finished(spark, f"{tmp_path}/out", ".stats.json").withColumn("meeting", src.F.regexp_replace("meeting", r"\.stats$", "")))
    assert again.turns.count() == 0


def test_discovery(spark, tmp_path):
    for name in ("b.MP4", "a.mkv", "c.f137.mp4", "d.temp.mp4", "e.txt"):
        (tmp_path / name).write_bytes(b"x")
    found = src.discover(spark, str(tmp_path), src.VIDEO_SUFFIXES).collect()
    assert sorted((r.name, r.meeting) for r in found) == [("a.mkv", "a"), ("b.MP4", "b")]
