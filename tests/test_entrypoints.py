"""The jobs end to end on a small corpus."""

import io
import json
import tarfile
import wave

import numpy as np
import pytest

from larkspan import schemas
from larkspan.plans import entrypoints as jobs
from larkspan.sources import parsers


def tone(seconds, rate=100):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.zeros(int(seconds * rate), "<i2").tobytes())
    return out.getvalue()


def rttm(*segments):
    return "".join(f"SPEAKER waveform 1 {a:.3f} {b - a:.3f} <NA> <NA> {s} <NA> <NA>\n" for s, a, b in segments).encode()


@pytest.fixture
def corpus(spark):
    files = spark.createDataFrame([("1", "p/1.wav", 20.0, "crawl"), ("2", "p/2.wav", 9.0, "liepa3-x"), ("3", "p/3.wav", 5.0, "liepa3-old"), ("4", "p/4.wav", 8.0, "web")], schemas.FILES)
    languages = json.dumps({"speaker": "A", "lang_res": [{"segment": {"start": 0, "end": 1}, "lang": "lt", "conf": 0.9}]}).encode()
    blobs = [
        ("1", jobs.RTTM, rttm(("A", 1, 4), ("B", 6, 9))),
        ("1", jobs.LANGUAGES, languages),
        ("2", jobs.RTTM, rttm(("A", 2, 3), ("B", 4, 5))),
        ("3", jobs.RTTM, rttm(("A", 2, 3))),
        ("4", jobs.SEGMENTS, b'["music", 0.0, 3.2]["speech", 3.2, 8.0]'),
        ("4", jobs.VAD, b'[{"from":1.0,"to":4.5}]'),
    ]
    kv = spark.createDataFrame([(*b, None) for b in blobs], schemas.KV)
    return files, kv, spark.createDataFrame([], schemas.FILE_SPEAKERS)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_curation(spark, corpus, tmp_path):
    files, kv, none = corpus
    people = jobs.build_file_speakers(none, files, kv, ["crawl", "liepa3-x"])
    assert rows(people, "file_id", "speaker", "duration_in_sec", "segments", "language") == [("1", "A", 3.0, 1, "lt"), ("1", "B", 3.0, 1, None), ("2", "A", 1.0, 1, None), ("2", "B", 1.0, 1, None)]
    (tmp_path / "c.jsonl").write_text('[{"sp": "A", "f": "1"}, {"sp": "A", "f": "2"}]\n[{"sp": "B", "f": "1"}]\n')
    clusters = parsers.read_clusters(spark, f"{tmp_path}/c.jsonl")
    people = jobs.name_clusters(people, clusters)
    predictions = spark.createDataFrame([("1", "A", "m"), ("2", "A", "m"), ("1", "B", "f")], schemas.GENDER_PREDICTION)
    people = jobs.vote_genders(people, clusters, predictions)
    named = {(r.file_id, r.speaker): (r.global_speaker, r.gender) for r in people.collect()}
    assert named["1", "A"] == named["2", "A"] and named["1", "A"][1] == "m" and named["2", "B"] == (None, None)
    assert rows(jobs.global_speakers(clusters, people), "sp", "duration", "duration_non_lt") == [("sp_00000", 3.0, 1.0), ("sp_00001", 0.0, 3.0)]
    final = jobs.build_segments(files, kv, people)
    assert rows(final, "id", "speaker", "lang", "start", "end") == [("1", "A", "lt", 0.7, 4.3), ("1", "B", "", 5.7, 9.3), ("2", "A", "", 0.0, 9.0)]
    chosen = jobs.select_segments(final, take=10.0)
    assert rows(chosen, "id", "speaker") == [("1", "A"), ("1", "B")]
    cuts = jobs.build_cuts(chosen, files)
    assert [(r.path, len(r.segments)) for r in cuts.collect()] == [("p/1.wav", 2)]
    placed = jobs.chunks(cuts, 5.0, 1)
    assert rows(placed, "source", "tar", "chunk") == [("crawl", 0, 0), ("crawl", 1, 1)]
    waves = spark.createDataFrame([("p/1.wav", tone(20))], "path string, content binary")
    made = jobs.write_shards(placed, waves, f"file://{tmp_path}/shards", rate=100).collect()
    assert sorted(r.members for r in made) == [1, 1]
    with tarfile.open(f"{tmp_path}/shards/crawl/000001.tar") as t:
        assert t.getnames() == ["crawl/000001/000001.wav"]


def test_side_jobs(spark, corpus, tmp_path):
    files, kv, _ = corpus
    assert rows(jobs.embedding_segments(kv, files.where("id = '1'")), "speaker", "start", "end") == [("A", 1.0, 4.0), ("B", 6.0, 9.0)]
    more = jobs.one_speaker_from_vad(kv, files, "web")
    assert rows(jobs.segments_of(more).where("id = '4'"), "speaker", "start", "end") == [("SPEAKER_00", 1.0, 4.5)]
    with pytest.raises(Exception, match="repeated key"):
        jobs.one_speaker_from_vad(more, files, "web").collect()
    wanted = spark.createDataFrame([("1", "A")], "f string, sp string")
    assert rows(jobs.speaker_segments(wanted, files, kv), "path", "start", "end") == [("p/1.wav", 1.0, 4.0)]
    with pytest.raises(Exception, match="no segments"):
        jobs.speaker_segments(spark.createDataFrame([("4", "A")], "f string, sp string"), files, kv).collect()
    sized = files.selectExpr("*", "10 AS length")
    totals = jobs.music_speech_totals(sized, kv, suffix=".wav")
    assert rows(totals["labels"], "music", "speech", "noise") == [(3.2, 4.8, 0.0)] and totals["skipped"].first().skipped == 0
    folder = tmp_path / "audio"
    folder.mkdir()
    (folder / "a.wav").write_bytes(tone(3))
    (folder / "b.txt").write_text("x")
    indexed = jobs.index_folder(spark, files, f"file://{folder}", "new", ["wav"])
    assert rows(indexed.where("source = 'new'"), "path", "duration_in_sec") == [("a.wav", 3.0)]
