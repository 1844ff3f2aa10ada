"""Parsers, keyed writes, artifacts, archives, function slots, audio, streams, graphs and models."""

import io
import sys
import tarfile
import wave
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspan.operators import audio, augment, graph, ml, ordered, similarity, udf_slots
from larkspan.sinks import archives, artifacts
from larkspan.sinks import tables as keyed
from larkspan.sources import parsers
from larkspan.sources import tables as scans
from larkspan.streaming import completeness


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_parsers(spark):
    text = "SPEAKER waveform 1 0.500 2.250 <NA> <NA> SPEAKER_00 <NA> <NA>\n# x\n\nshort line\n"
    df = spark.createDataFrame([("1", text, '["speech", 0.0, 3.2]["music", 3.2, 9.96]', '[{"from":0.1,"to":2.0}]')], "id string, rttm string, ina string, vad string")
    assert rows(parsers.parse_rttm(df, F.col("rttm")), "id", "uri", "speaker", "start", "end") == [("1", "waveform", "SPEAKER_00", 0.5, 2.75)]
    assert rows(parsers.parse_segments(df, F.col("ina")), "label", "start", "end") == [("music", 3.2, 9.96), ("speech", 0.0, 3.2)]
    assert rows(parsers.parse_vad(df, F.col("vad")), "start", "end") == [(0.1, 2.0)]
    emb = spark.createDataFrame([("1", '{"sp": "A", "emb": [1.0]}\n{"sp": "A", "emb": [2.0]}\n')], "id string, c string")
    assert rows(parsers.parse_embeddings(emb, F.col("c")), "sp", "emb") == [("A", [2.0])]
    lang = spark.createDataFrame([("1", '{"speaker": "A", "lang_res": [{"segment": {"start": 0, "end": 1}, "lang": "lt", "conf": 0.5}]}')], "id string, c string")
    assert parsers.parse_languages(lang, F.col("c")).first().lang_res[0].lang == "lt"


def test_repeated_new_keys_are_writes_in_order(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 5)], "k int, v string, created_at int")
    news = [(2, "first", 1, 7), (2, "last", 2, 9), (3, "x", 31, 8), (3, None, 32, 9), (1, None, 3, 3), (None, "N", 6, 1)]
    new = spark.createDataFrame(news, "k int, v string, created_at int, at int")
    own = new.select("k", "v", "created_at", "at")
    assert rows(keyed.upsert(old, own, ["k"], order=["at"]).where("k is not null"), "k", "v", "created_at") == [(1, None, 10), (2, "last", 20), (3, None, 31)]
    assert rows(keyed.merge_columns(old, own, ["k"], ["v"], ["at"]).where("k is not null"), "k", "v", "created_at") == [(1, "a", 10), (2, "last", 20), (3, "x", None)]
    assert rows(keyed.update_columns(old, own, ["k"], ["v"], ["at"]), "k", "v") == sorted([(1, "a"), (2, "last"), (None, "n")], key=repr)
    assert rows(keyed.insert_if_absent(old, own, ["k"], ["at"]).where("k is not null"), "k", "v") == [(1, "a"), (2, "b"), (3, "x")]
    for write in (keyed.upsert(old, own, ["k"]), keyed.insert_if_absent(old, own, ["k"])):
        assert write.groupBy("k").count().where("count > 1 and k is not null").isEmpty() and write.exceptAll(write).isEmpty()


def test_text_scans(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('[{"sp": "SPEAKER_00", "f": "abc"}]\n\n[{"sp": "S", "f": "x"}, {"sp": "T", "f": "y"}]\n')
    found = parsers.read_clusters(spark, f"{tmp_path}/c.jsonl")
    assert rows(found, "sp", "f", "pos") == [("S", "x", 0), ("SPEAKER_00", "abc", 0), ("T", "y", 1)]
    (tmp_path / "g.jsonl").write_text('{"sp": "a", "duration": 1, "duration_non_lt": 2.5}\n')
    assert parsers.read_jsonl(spark, f"{tmp_path}/g.jsonl", "sp string, duration double, duration_non_lt double").first().duration == 1.0
    (tmp_path / "r.txt").write_text("a 0.5\nb\n")
    words = parsers.read_words(spark, f"{tmp_path}/r.txt")
    assert rows(words, "name", "value") == [("a", 0.5), ("b", None)] and parsers.with_absent(words).count() == 4
    assert scans.walk(spark, str(tmp_path), ["JSONL"]).count() == 2 and scans.walk(spark, str(tmp_path), names=[" r.txt "]).count() == 1


def test_keyed_writes(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, created_at int")
    new = spark.createDataFrame([(2, "B", 99), (3, "C", 30)], "k int, v string, created_at int")
    assert rows(keyed.upsert(old, new, ["k"]), "k", "v", "created_at") == [(1, "a", 10), (2, "B", 20), (3, "C", 30)]
    assert rows(keyed.insert_if_absent(old, new, ["k"]), "k", "v") == [(1, "a"), (2, "b"), (3, "C")]
    assert rows(keyed.update_columns(old, new, ["k"], ["v"]), "k", "v") == [(1, "a"), (2, "B")]
    assert rows(keyed.merge_columns(old, new, ["k"], ["v"]), "k", "v", "created_at") == [(1, "a", 10), (2, "B", 20), (3, "C", None)]
    with pytest.raises(Exception, match="repeated key"):
        keyed.insert_strict(old, new, ["k"]).collect()
    with pytest.raises(Exception, match="no thing"):
        keyed.assert_all_found(new, old, ["k"], "thing").collect()


def test_artifacts(spark):
    segs = spark.createDataFrame([("1", "A", 0.5, 2.75)], "id string, speaker string, start double, end double")
    assert artifacts.rttm_text(segs).first().content == "SPEAKER waveform 1 0.500 2.250 <NA> <NA> A <NA> <NA>\n"
    marks = spark.createDataFrame([("1", "music", 3.0, 4.0)], "id string, label string, start double, end double")
    grid = artifacts.textgrid(segs, marks).first().content
    assert 'name = "A"' in grid and 'name = "SM"' in grid and "xmax = 4.01" in grid
    lines = artifacts.manifest(spark.createDataFrame([("b.wav", 2), ("a.wav", 1)], "path string, nsamples long"), "/root").collect()
    assert [r.line for r in lines] == ["/root", "a.wav\t1", "b.wav\t2"]
    assert [r.line for r in artifacts.unit_dictionary(spark, 2).collect()] == ["0 1", "1 1"]


def test_archives(spark, tmp_path):
    members = spark.createDataFrame([("s", 0, "a.wav", b"12"), ("s", 0, "b.wav", b"3"), ("s", 1, "c.wav", b"4"), ("s", 1, "empty.wav", b"")], "source string, tar int, member string, data binary")
    made = archives.write_tars(members, ["source", "tar"], f"file://{tmp_path}/tars").collect()
    assert sorted(r.members for r in made) == [1, 2]
    with tarfile.open(f"{tmp_path}/tars/s/0.tar") as t:
        assert sorted(t.getnames()) == ["a.wav", "b.wav"]
    back = archives.read_tars(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{tmp_path}/tars"))
    assert rows(back.select("member", F.col("data").cast("string").alias("d")), "member", "d") == [("a.wav", "12"), ("b.wav", "3"), ("c.wav", "4")]
    archives.write_zips(members.withColumn("all", F.lit("z")), ["all"], f"file://{tmp_path}").collect()
    assert len(zipfile.ZipFile(f"{tmp_path}/z.zip").namelist()) == 4
    kv = spark.createDataFrame([("f1", "vad.json", b"[]")], "id string, type string, content binary")
    archives.export_artifacts(kv, f"file://{tmp_path}/kv").collect()
    assert rows(scans.read_blobs(spark, f"{tmp_path}/kv", ["vad.json"]), "id", "type") == [("f1", "vad.json")]


def test_slots(spark):
    files = spark.createDataFrame([("1", "p1"), ("2", "p2"), ("3", "p3")], "id string, path string")
    kv = spark.createDataFrame([("1", "in", b"one"), ("3", "in", b"three"), ("3", "out", b"x")], "id string, type string, content binary")
    found = udf_slots.map_files(files, kv, ["out"], ["in"], "cp {input}/in {output}")
    assert rows(found.select("id", "status", F.col("result").cast("string").alias("r")), "id", "status", "r") == [("1", "success", "one"), ("2", "not_found", None), ("3", "skipped", None)]
    bad = udf_slots.map_command(udf_slots.with_inputs(files, kv, ["in"]).where("id = '1'"), "ls {input}/none {output}", "o").first()
    assert bad.status == "failed" and bad.error
    with pytest.raises(ValueError):
        udf_slots.check_template("cp {input} x")
    worker = [sys.executable, "-u", "-c", "import sys\nfor l in sys.stdin: print('noise'); print('wrk-res: ok' if 'p1' in l else 'wrk-res: error bad')"]
    tasks = files.select("id", F.col("path").alias("input_wav"), F.lit("i").alias("input"), F.lit("o").alias("output"))
    assert rows(udf_slots.map_worker(tasks, worker), "id", "status", "error")[:2] == [("1", "success", None), ("2", "failed", "bad")]
    memo = spark.createDataFrame([("1", b"old", None, True), ("2", None, "e", False)], "id string, result binary, error string, ok boolean")
    got = udf_slots.memoised(files, memo, lambda: lambda v: v.encode() if v != "p3" else 1 / 0, "path")
    assert rows(got.select("id", F.col("result").cast("string").alias("r"), "ok"), "id", "r", "ok") == [("1", "old", True), ("2", "p2", True), ("3", None, False)]


def tone(samples, rate=100):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.arange(samples, dtype="<i2").tobytes())
    return out.getvalue()


def test_audio(spark):
    files = spark.createDataFrame([("1", tone(1000)), ("2", b"junk")], "id string, content binary")
    assert rows(files.select("id", audio.wave_duration(F.col("content")).alias("d")), "id", "d") == [("1", 10.0), ("2", 0.0)]
    ranges = spark.createDataFrame([("1", 1.0, 2.0), ("1", 0.0, 0.5)], "id string, start double, end double")
    made = audio.cut_files(files, ranges).first().audio
    with wave.open(io.BytesIO(bytes(made))) as w:
        got = np.frombuffer(w.readframes(10_000), "<i2")
    assert got.tolist() == [*range(50), *range(100, 200)]
    assert audio.duration_of(audio.joined([tone(100), tone(50)])) == 1.5
    assert audio.duration_of(audio.cut(tone(100), [(0, 0.5)], silence=1.0)) == 1.5
    with pytest.raises(ValueError):
        audio.cut(tone(10), [(0, 1)], rate=16000)


def test_completeness(spark, tmp_path):
    events = [("tar", "a", ""), *[("tar_file", "a", "")] * 2, *[("file_done", "a", "")] * 6, ("tar", "b", ""), *[("tar_file", "b", "")] * 2, *[("file_done", "b", "")] * 5, ("tar", "c", "")]
    df = spark.createDataFrame(events, "type string, tar string, value string")
    assert rows(augment.completeness(df), "tar", "complete") == [("a", True), ("b", False), ("c", False)]
    df.write.json(f"{tmp_path}/events")
    stream = completeness.complete_tars(spark.readStream.schema(df.schema).json(f"{tmp_path}/events"))
    query = stream.writeStream.format("memory").queryName("tars").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    query.awaitTermination(120)
    assert rows(spark.table("tars"), "tar", "files", "done", "complete") == [("a", 2, 6, True)]


def test_ingest_once(spark, tmp_path):
    spark.range(5).write.json(f"{tmp_path}/in")
    for _ in range(2):
        completeness.ingest(spark, f"{tmp_path}/in", "id long", f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_graph(spark):
    nodes = spark.createDataFrame([(i,) for i in range(9)], "node long")
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (2, 0, 1.0), (3, 4, 1.0), (4, 5, 1.0), (5, 3, 1.0), (2, 3, 0.1), (7, 6, 1.0)], "src long, dst long, w double")
    assert rows(graph.components(nodes, edges), "node", "component") == [*[(i, 0) for i in range(6)], (6, 6), (7, 6), (8, 8)]
    found = graph.communities(nodes, edges)
    assert dict(rows(found, "node", "community")) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3, 6: 6, 7: 6, 8: 8}
    assert graph.modularity(found, edges) > graph.modularity(graph.components(nodes, edges).withColumnRenamed("component", "community"), edges)
    # four cliques of four in a ring: whole groups move, communities are connected, a second level can only help
    ring = [(4 * c + i, 4 * c + k, 1.0) for c in range(4) for i in range(4) for k in range(i)] + [(4 * c + 3, (4 * c + 4) % 16, 0.5) for c in range(4)]
    cliques = graph.communities(spark.range(16).withColumnRenamed("id", "node"), spark.createDataFrame(ring, "src long, dst long, w double"))
    assert dict(rows(cliques, "node", "community")) == {n: n // 4 * 4 for n in range(16)}


def test_knn_by_lists_recalls_exact(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((10, 16))
    v = np.concatenate([c + 0.2 * rng.standard_normal((30, 16)) for c in centres])
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, emb array<float>")
    exact = {(r.src, r.dst) for r in similarity.knn(df, k=10, least=0.5).collect()}
    lists = {(r.src, r.dst) for r in similarity.knn(df, k=10, least=0.5, lists=8, probes=3).collect()}
    assert len(exact) == 300 * 9 and len(exact & lists) >= 0.9 * len(exact)


def test_registered_edges_are_exact_at_every_size(spark, tmp_path, monkeypatch):
    from larkspan.plans import queries

    def refused(*_):
        raise AssertionError("inverted lists")

    monkeypatch.setattr(similarity, "BLOCK_ROWS", 64)
    monkeypatch.setattr(similarity, "centroids", refused)
    v = np.random.default_rng(3).standard_normal((300, 8)).astype(np.float32)
    spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    x = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = x.astype(np.float64) @ x.T.astype(np.float64)
    want = set()
    for i, s in enumerate(sims):
        others = sorted((j for j in range(300) if j != i and s[j] >= 0.3), key=lambda j: -s[j])[:49]
        want |= {(min(i, j), max(i, j)) for j in others}
    assert {(r.src, r.dst) for r in queries.near_edges(spark, str(tmp_path)).collect()} == want


def test_ordered_across_parts(spark):
    df = spark.range(1000, numPartitions=7).withColumn("v", F.floor(F.col("id") / 10))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(ordered.runs(df, ["id"], "v"), "id", "run")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == sorted(((i, i // 10 + 1) for i in range(1000)), key=repr)


def test_gender_model(spark):
    rng = np.random.default_rng(2)
    data = [([float(x) for x in rng.standard_normal(4) + (1.5 if m else -1.5)], "m" if m else "f") for m in rng.integers(0, 2, 200)]
    df = spark.createDataFrame(data, "emb array<float>, g string")
    found = ml.predict_gender(ml.train_gender(df), df.withColumnRenamed("g", "truth"), dead_band=0.0)
    assert found.where("g = truth").count() >= 190
