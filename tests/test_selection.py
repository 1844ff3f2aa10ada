"""Golden cases of selection, packing, votes, reports and scalars."""

import pytest
from pyspark.sql import functions as F

from larkspan.functions import scalars
from larkspan.operators import reports, votes
from larkspan.operators import selection as sel


def budget(spark, rows, **settings):
    data = [(i, "g", "m", s, 0.0, float(d)) for i, (d, s) in enumerate(rows, 1)]
    df = spark.createDataFrame(data, "seg long, gs string, gender string, source string, start double, end double")
    return sorted(r.seg for r in sel.select_budget(df, order=["seg"], **settings).collect())


def test_budget(spark):
    assert budget(spark, [(30, "crawl"), (30, "crawl"), (25, "x"), (20, "x"), (30, "x")], take=100.0, male=50.0) == [1, 3, 4]
    assert budget(spark, [(25, "x"), (25, "x"), (60, "x"), (45, "x")], take=100.0) == [1, 2, 4]


def test_next_fit_and_tars(spark):
    rows = [("s", "f1", 0, 0.0, 20.0), ("s", "f1", 1, 0.0, 15.0), ("s", "f2", 0, 0.0, 10.0), ("s", "f2", 1, 0.0, 40.0), ("t", "f3", 0, 0.0, 5.0)]
    chunks = sel.next_fit(spark.createDataFrame(rows, "source string, path string, pos long, start double, end double"), 30.0)
    assert sorted((r.source, r.path, r.pos, r.chunk) for r in chunks.collect()) == [("s", "f1", 0, 0), ("s", "f1", 1, 1), ("s", "f2", 0, 1), ("s", "f2", 1, 2), ("t", "f3", 0, 0)]
    assert sorted({(r.source, r.tar, r.chunk) for r in sel.tars(chunks, 2).collect()}) == [("s", 0, 0), ("s", 0, 1), ("s", 1, 2), ("t", 0, 0)]
    assert sel.cuts(chunks).count() == 5


def test_runs(spark):
    files = lambda paths: spark.createDataFrame([(str(i), p) for i, p in enumerate(paths)], "id string, path string")
    assert [r.path for r in sel.first_of_runs(files(["/a/1", "/a/2", "/a/3", "/b/1"]), 2).orderBy("path").collect()] == ["/a/1", "/a/2", "/b/1"]
    assert sel.folder_clusters(files(["/a/1.wav", "/a/b/x.wav", "/a/c.wav"])).count() == 3
    assert sel.first_of_runs(files([]), 2).count() == 0


@pytest.mark.parametrize("n, parts", [(100, (95, 2, 3)), (10, (9, 0, 1))])
def test_split(spark, n, parts):
    got = {r.part: r.n for r in sel.split(spark.createDataFrame([(f"f{i}",) for i in range(n)], "path string"), "path").groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert tuple(got.get(p, 0) for p in ("train", "valid", "test")) == parts


def test_until_budget(spark):
    df = spark.createDataFrame([("a", i, 50.0) for i in range(5)], "g string, i int, d double")
    assert sorted(r.i for r in sel.until_budget(df, ["g"], ["i"], F.col("d"), 120.0).collect()) == [0, 1, 2]


def test_ranges():
    assert sel.parse_range("2:5") == (2, 5) and sel.parse_range("7") == (7, 8)
    for bad in ("", "5:2", "a", "1:2:3"):
        with pytest.raises(ValueError):
            sel.parse_range(bad)


LANGUAGES = [
    ([], "unk"),
    ([("lt", 0.9)] * 5, "lt"),
    ([("lt", 0.9)] * 4 + [("ru", 0.5)], "lt"),
    ([("lt", 0.9)] * 4 + [("ru", 0.6)], "ru"),
    ([("lt", 0.9)] * 3 + [("ru", 0.1)], "ru"),
    ([("ru", 0.3), ("en", 0.7)], "en"),
    ([("ru", 0.5), ("en", 0.5)], "ru"),
    ([("ru", 0.0)], ""),
]


def test_language_decision(spark):
    df = spark.createDataFrame([(i, found) for i, (found, _) in enumerate(LANGUAGES)], "i int, found array<struct<lang: string, conf: double>>")
    got = {r.i: r.l for r in df.select("i", votes.language_decision(F.col("found")).alias("l")).collect()}
    assert [got[i] for i in range(len(LANGUAGES))] == [want for _, want in LANGUAGES]


def test_gender_vote(spark):
    cases = {"1": "mmf", "2": "mf", "3": "m-", "5": "ff-"}
    df = spark.createDataFrame([(k, g) for k, v in cases.items() for g in v], "c string, g string")
    assert {r.c: r.gender for r in votes.gender_vote(df, ["c"], "g").collect()} == {"1": "m", "2": "-", "3": "-", "5": "f"}


def test_histogram(spark):
    got = {r.bin: (r.n, r.running) for r in reports.histogram(spark.createDataFrame([(0,), (10,), (20,), (100,)], "x int"), "x", 4).collect()}
    assert got == {0: (3, 3), 4: (1, 4)}
    assert reports.histogram(spark.createDataFrame([(5,), (5,)], "x int"), "x", 4).collect()[0].n == 2


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("seconds, text", [(10, "10s"), (10.7, "10s"), (3000, "50m"), (10000, "2h 46m"), (18 * 3600 + 90, "18h 1m"), (50 * 3600 + 80, "2d 2h"), (50 * 86400 + 10 * 3600 + 50, "50d 10h")])
def test_duration_text(spark, seconds, text):
    assert value(spark, scalars.duration_text(F.lit(float(seconds)))) == text


@pytest.mark.parametrize(
    "path, same, want",
    [("/input/file.m4a", False, "/output/file.m4a/result.txt"), ("/input/file.m4a", True, "/output/result.txt"), ("/input/olia/file.m4a", False, "/output/olia/file.m4a/result.txt"), ("/input/olia/file.m4a", True, "/output/olia/result.txt")],
)
def test_output_path(spark, path, same, want):
    assert value(spark, scalars.output_path(F.lit(path), "/input", "/output", "result.txt", same)) == want


@pytest.mark.parametrize("extensions, name, want", [([], "file.txt", True), (["txt"], "file.txt", True), (["jpg"], "file.txt", False), (["jpg", "txt"], "file.txt", True), (["txt"], "file", False), (["txt"], "", False), (["txt"], "a/FILE.TXT", True)])
def test_extension(spark, extensions, name, want):
    assert value(spark, scalars.has_extension(F.lit(name), extensions)) is want


@pytest.mark.parametrize("suffix, want", [("", True), ("txt", True), ("jpg", False), ("file.txt", True)])
def test_suffix(spark, suffix, want):
    assert value(spark, scalars.has_suffix(F.lit("file.txt"), suffix)) is want


def test_names_and_codes(spark):
    assert value(spark, scalars.cluster_name(F.lit('[{"sp": "SPEAKER_00", "f": "abc"}]'))) == "s_ee2e9795c7"
    assert value(spark, scalars.language_code(F.lit("lt: Lithuanian"))) == "lt"
    assert value(spark, scalars.stem(F.lit("a/b.c.wav"))) == "b.c"
    assert [value(spark, scalars.gender_of_probability(F.lit(p))) for p in (0.7, 0.3, 0.5)] == ["m", "f", "-"]
    assert scalars.size_bytes("10G") == 10 << 30 and scalars.size_bytes("512") == 512


def test_moving_average(spark):
    for given, want in (([1, 2, 3], 2.0), ([1, 3], 2.0), ([1, 2, 3, 4], 3.0), ([1, 2, 3, 4, 5], 4.0)):
        df = spark.createDataFrame(list(enumerate(given)), "i int, x int")
        assert sel.moving_average(df, "x", ["i"], last=3).orderBy(F.desc("i")).first().moving == want


def test_reports_take_positive_durations(spark):
    df = spark.createDataFrame([("a", 7200.0), ("b", 0.0), ("c", -5.0), ("d", 1800.0), ("e", None), ("d", 1800.0)], "sp string, duration double")
    assert [tuple(r) for r in reports.top_sums(df, "sp", "duration", 50).collect()] == [("a", 7200.0), ("d", 3600.0)]
    got = [tuple(r) for r in reports.cap_sweep(df, F.col("duration"), (1, 2)).collect()]
    assert got == [(1.0, 7200.0, 1, 3600.0, 3), (2.0, 10800.0, 0, 0.0, 3)]
