"""Golden cases of interval operators."""

import pytest
from pyspark.sql import functions as F

from larkspan.operators import intervals as iv


def rounded(df, *columns):
    return sorted(tuple(round(x, 3) if isinstance(x, float) else x for x in r) for r in df.select(*columns).collect())


RECONCILED = [
    ([("A", 1, 4, 0), ("B", 6, 9, 0)], 20, [("A", 0.7, 4.3), ("B", 5.7, 9.3)]),
    ([("A", 0, 2, 0), ("B", 2.2, 4, 0)], 4.1, [("A", 0, 2.1), ("B", 2.1, 4.1)]),
    ([("A", 0, 5, 0), ("B", 3, 10, 0)], 20, [("A", 0, 3), ("B", 5, 10.3)]),
    ([("A", 0, 5, 0), ("B", 3, 10, 0), ("C", 4, 12, 0)], 20, [("A", 0, 3), ("B", 5, 4), ("C", 10, 12.3)]),
    ([("A", 0, 4, 0), ("M", 4.5, 8, 1), ("B", 8.1, 10, 0)], 20, [("A", 0, 4.3), ("B", 8.1, 10.3)]),
    ([("A", 0, 0.1, 0), ("B", 1, 3, 0)], 3, [("B", 1, 3)]),
    ([], 3, []),
]


def test_reconcile(spark):
    rows = [(str(k), s, float(a), float(b), bool(m), float(d), i) for k, (segs, d, _) in enumerate(RECONCILED) for i, (s, a, b, m) in enumerate(segs)]
    df = spark.createDataFrame(rows, "id string, speaker string, start double, end double, music boolean, duration double, pos int")
    want = sorted((str(k), s, float(a), float(b)) for k, (_, _, out) in enumerate(RECONCILED) for s, a, b in out)
    assert rounded(iv.reconcile(df), "id", "speaker", "start", "end") == want


def test_whole_file(spark):
    df = spark.createDataFrame([("1", "A", 2.0, 3.0, False, 9.0, 0), ("1", "B", 4.0, 5.0, False, 9.0, 1)], "id string, speaker string, start double, end double, music boolean, duration double, pos int")
    assert rounded(iv.whole_file(df), "speaker", "start", "end") == [("A", 0.0, 9.0)]


@pytest.mark.parametrize(
    "given, want",
    [
        ([("a", 0, 1), ("a", 1.1, 2), ("b", 2.1, 3)], [("a", 0, 2), ("b", 2.1, 3)]),
        ([("a", 0, 20), ("a", 20.1, 31)], [("a", 0, 20), ("a", 20.1, 31)]),
        ([("a", 0, 1), ("b", 1.1, 2), ("a", 2.1, 3)], [("a", 0, 1), ("a", 2.1, 3), ("b", 1.1, 2)]),
    ],
)
def test_merge(spark, given, want):
    df = spark.createDataFrame([("1", s, float(a), float(b)) for s, a, b in given], "id string, speaker string, start double, end double")
    assert rounded(iv.merge_neighbours(df), "speaker", "start", "end") == sorted((s, float(a), float(b)) for s, a, b in want)


def test_restore_time(spark):
    speech = spark.createDataFrame([("1", 10.0, 15.0), ("1", 20.0, 30.0)], "id string, start double, end double")
    assert rounded(iv.offsets(speech), "offset", "shift") == [(0.0, 10.0), (5.0, 15.0)]
    times = spark.createDataFrame([("1", 0.0), ("1", 3.0), ("1", 5.0)], "id string, t double")
    moved = iv.as_of(times, iv.offsets(speech).select("id", "offset", "shift"), "id", "t", "offset", "shift")
    assert rounded(moved.select((F.col("t") + F.col("shift")).alias("x")), "x") == [(10.0,), (13.0,), (20.0,)]
    spoken = spark.createDataFrame([("1", "A", 3.0, 7.0)], "id string, speaker string, start double, end double")
    assert rounded(iv.restore_time(spoken, speech), "speaker", "start", "end") == [("A", 13.0, 15.0), ("A", 20.0, 22.0)]


def test_overlaps_by_cells(spark):
    a = spark.createDataFrame([("1", i, float(i), float(i) + 2.5) for i in range(40)], "id string, n int, start double, end double")
    plain = rounded(iv.overlaps(a, a, ["id"]), "n", "r_n", "common_start", "common_end")
    assert plain == rounded(iv.overlaps(a, a, ["id"], cell=3.0), "n", "r_n", "common_start", "common_end") and len(plain) > 40


def test_restore_time_of_rows_in_another_order_each_time(spark):
    speech = spark.createDataFrame([("1", 10.0, 15.0), ("1", 20.0, 20.0), ("1", 30.0, 40.0)], "id string, start double, end double")
    rows = [("1", i, i / 10, i / 10 + 0.05) for i in range(100)]

    def stirred(batches):
        import secrets

        for b in batches:
            yield b.sample(frac=1, random_state=secrets.randbits(32))

    spoken = spark.createDataFrame(rows, "id string, n int, start double, end double").mapInPandas(stirred, "id string, n int, start double, end double")
    want = [(n, round(a + (10 if n < 50 else 25), 3), round(b + (10 if n < 50 else 25), 3)) for _, n, a, b in rows]
    assert rounded(iv.restore_time(spoken, speech), "n", "start", "end") == want


def test_solo(spark):
    df = spark.createDataFrame([("1", 1, 0.0, 5.0), ("1", 2, 3.0, 8.0), ("2", 3, 0.0, 5.0), ("2", 4, 0.0, 5.0)], "id string, n long, start double, end double")
    assert rounded(iv.solo(df, "n"), "n", "start", "end") == [(1, 0.0, 3.0), (2, 5.0, 8.0)]


def test_probe_windows(spark):
    segs = spark.createDataFrame([("1", 2.0, 4.0), ("1", 6.0, 20.0)], "id string, start double, end double")
    at = spark.createDataFrame([("1", 0.0), ("1", 8.0)], "id string, at double")
    assert rounded(iv.probe_windows(segs, at, 5.0), "at", "start", "end") == [(0.0, 6.0, 11.0), (8.0, 15.0, 20.0)]
    assert iv.spread_probes(segs).where("length = 5.0").count() == 2


def test_chop(spark):
    df = spark.createDataFrame([(0.0, x) for x in (28.0, 28.5, 48.0, 50.0)], "start double, end double").withColumn("n", F.col("end"))
    got = rounded(iv.chop(df).withColumn("d", F.col("end") - F.col("start")), "n", "piece", "d")
    assert got == [(28.0, 0, 28.0), (28.5, 0, 20.0), (28.5, 1, 8.5), (48.0, 0, 20.0), (48.0, 1, 28.0), (50.0, 0, 20.0), (50.0, 1, 20.0), (50.0, 2, 10.0)]


def test_longest_middles(spark):
    df = spark.createDataFrame([("a", 0.0, 10.0), ("a", 20.0, 22.0), ("b", 0.0, 4.0)], "speaker string, start double, end double")
    assert rounded(iv.longest_middles(df, ["speaker"], 5.0), "speaker", "start", "end") == [("a", 2.5, 7.5)]
    assert rounded(iv.longest_middles_with_fallback(df, ["speaker"]), "speaker", "start", "end") == [("a", 2.5, 7.5), ("b", 0.5, 3.5)]


def test_overlaps_spread_over_cells_by_default(spark):
    import random

    rng = random.Random(4)
    make = lambda n: [("k" if rng.random() < 0.9 else "q", i, s := rng.random() * 50, s + rng.choice([0.0, 0.3, 1.0, 30.0])) for i in range(n)]
    left, right = make(120), make(120)
    frames = [spark.createDataFrame(x, "id string, n int, start double, end double") for x in (left, right)]
    got = {(r.n, r.r_n) for r in iv.overlaps(*frames, ["id"]).collect()}
    assert got == {(a[1], b[1]) for a in left for b in right if a[0] == b[0] and a[3] > b[2] and a[2] < b[3]}
    assert iv.overlaps(frames[0].limit(0), frames[1].limit(0), ["id"]).isEmpty()
