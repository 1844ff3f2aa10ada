"""Line dedup and pseudonyms: native operators."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larkspan.llm import line_dedup, pii


def brute(rows, n):
    lines = {(i, t): (t or "").split("\n") for i, t in rows}
    key = lambda x: re.sub("[\x20\x09-\x0d]+", " ", x).strip(" ")
    first = {}
    places = sorted((i if i is not None else -1, hashlib.sha256((t or "").encode()).hexdigest(), i, t, k) for (i, t), own in lines.items() for k in range(len(own)))
    for *_, i, t, k in places:
        run = tuple(map(key, lines[i, t][k : k + n]))
        if len(run) == n:
            first.setdefault(run, (i, t, k))
    out = {}
    for (i, t), own in lines.items():
        gone = set()
        for k in range(len(own) - n + 1):
            if first[tuple(map(key, own[k : k + n]))] != (i, t, k):
                gone |= set(range(k, k + n))
        out[i, t] = (len(own), len(gone), sum(k - 1 not in gone for k in gone), "\n".join(x for k, x in enumerate(own) if k not in gone))
    return sorted(((i, *out[i, t]) for i, t in rows), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_lines(docs, n):
    rng = random.Random(n)
    rows = [(i, "\n".join(rng.choice(["a", "b ", " c", "d  d", "d d", ""]) for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a\n" * 40), rows[0], (103, "x" * 200_000 + "\na\nb\nc\nd")]
    got = line_dedup.line_dedup(docs(rows), min_lines=n, min_words=None)
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.n_runs, r.text) for r in got.collect()), key=repr) == brute(rows, n)
    assert line_dedup.line_dedup(docs([]), min_lines=n).count() == 0


def brute_words(rows, n, words):
    """Every run of n lines or so many words: all places but the first go."""
    lines = {i: [re.sub("[\x20\x09-\x0d]+", " ", x).strip(" ") for x in t.split("\n")] for i, t in rows}
    first, gone = {}, defaultdict(set)
    for i in sorted(lines):
        for k in range(len(lines[i])):
            for e in range(k + 1, len(lines[i]) + 1):
                run = tuple(lines[i][k:e])
                if (len(run) >= n or sum(len(x.split()) for x in run) >= words) and first.setdefault(run, (i, k)) != (i, k):
                    gone[i] |= set(range(k, e))
    return {i: sorted(gone[i]) for i in lines if gone[i]}


@pytest.mark.parametrize("n, words", [(1, 5), (2, 4), (3, 4), (3, 6), (5, 7), (6, 9)])
def test_runs_of_many_words(docs, n, words):
    rng = random.Random(n * 100 + words)
    pieces = ["a", "b  c", "d e f ", "g h i j k", "", "l m n o p q r"]
    rows = [(i, "\n".join(rng.choice(pieces) + rng.choice(["", "", f" {i}"]) for _ in range(rng.randrange(1, 9)))) for i in range(40)]
    own = line_dedup._keyed(docs([*rows, rows[0]]), "doc_id", "text")
    got = {r.id: [k for a, b in zip(r.lows, r.highs, strict=True) for k in range(a, b)] for r in line_dedup.deleted_spans(own, n, words).collect()}
    assert got == brute_words(rows, n, words)


def test_repeated_passage_on_one_line(docs):
    passage, half = (" ".join(f"{c}{k}" for k in range(m)) for c, m in (("w", 51), ("h", 49)))
    rows = [(1, passage), (2, passage), (3, f"x\n{passage}\ny"), (4, half), (5, half), (6, f"{half}\nz\nq"), (7, f"{half}\nz\nr")]
    got = {r.doc_id: (r.n_removed, r.text) for r in line_dedup.line_dedup(docs(rows)).collect()}
    assert got == {1: (0, passage), 2: (1, ""), 3: (1, "x\ny"), 4: (0, half), 5: (0, half), 6: (0, rows[5][1]), 7: (2, "r")}


def test_ranks_keep_the_order_of_runs(docs):
    """Ranks of pairs order positions as the sorted runs do, so that they make up a suffix array to that depth."""
    rng = random.Random(9)
    rows = [(i, "\n".join(rng.choice("abcd") for _ in range(12))) for i in range(20)]
    own = line_dedup._keyed(docs(rows), "doc_id", "text")
    lines = own.select("id", "th", F.posexplode("lines").alias("line", "key"))
    first = line_dedup.written(line_dedup._ranked(line_dedup.written(lines, "t"), ["key"]).withColumnRenamed("rank", "a").drop("later"), "t")
    pairs = line_dedup.written(first.withColumn("b", line_dedup._ahead(1, "a")).where("b is not null"), "t")
    texts = {i: t.split("\n") for i, t in rows}
    at = defaultdict(list)
    for r in line_dedup._ranked(pairs, ["a", "b"]).collect():
        at[r.rank].append((tuple(texts[r.id][r.line : r.line + 2]), (r.id, r.line), r.later))
    runs = [at[k] for k in sorted(at)]
    assert [x[0][0] for x in runs] == sorted({x[0][0] for x in runs}) and all(len({run for run, _, _ in x}) == 1 for x in runs)
    assert all(later == (place > min(p for _, p, _ in x)) for x in runs for _, place, later in x)


def test_long_and_hot_runs(docs):
    """Long copies double many times; a text of very many deleted lines takes linear time; runs end at the deepest depth."""
    long = "\n".join(f"line {k}" for k in range(3000))
    rows = [(1, long), (2, "head\n" + long), (3, long + "\ntail"), (4, "\n" * 50_000), (5, None)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.text) for r in line_dedup.line_dedup(docs(rows)).collect()}
    assert got[1] == (3000, 0, 0, long) and got[2] == (3001, 3000, 1, "head") and got[3] == (3001, 3000, 1, "tail")
    assert got[4] == (50_001, 50_000, 1, "") and got[5] == (1, 0, 0, "")
    own = line_dedup._keyed(docs(rows[:2]), "doc_id", "text")
    runs = [(r.line, r.length) for r in line_dedup.later_runs(own).collect()]
    assert max(n for _, n in runs) == 2048 and len(runs) <= 3000


def feistel(value, a, b, key, tweak, rounds=pii.ROUNDS):
    left, right = value // b, value % b

    def half(i, h):
        return int(hashlib.sha256(f"{key}|{tweak}|{i}|{h}|{key}".encode()).hexdigest()[:15], 16)

    for i in range(rounds):
        if i % 2 == 0:
            left = (left + half(i, right)) % a
        else:
            right = (right + half(i, left)) % b
    return left * b + right


def test_feistel_against_python_and_bijective(spark):
    f = pii.feistel(F.col("id"), F.lit(7).cast("long"), F.lit(11).cast("long"), "k", F.lit("t"))
    got = {r.id: r.y for r in spark.range(77).select("id", f.alias("y")).collect()}
    assert got == {i: feistel(i, 7, 11, "k", "t") for i in range(77)} and sorted(got.values()) == list(range(77))


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


ROWS = [
    (1, "Call +1 (555) 123-4567 or 4111111111111111, ip 10.0.255.3, bad 10.0.256.3 and 4111-1111-1111-1112."),
    (2, "again 4111111111111111 on 2021-02-28 and 28/02/2021 not 2021-02-30; bob.77@mail3.example.com"),
    (3, None),
    (4, ""),
    (5, "123-45-6789 000-12-1234 and +370 612 34567 x1.2.3.4.5 3.14159 100000000 4111 1111 1111 1111"),
    (6, "2021-02-28 tel 555-123-4567."),
    (7, "lorem " * 50_000 + "10.0.255.3"),
]


def test_pseudonyms(docs):
    got = {r.doc_id: r for r in pii.pseudonymised(docs(ROWS), "k").collect()}
    assert {i: r.kinds for i, r in got.items()} == {1: ["phone", "card", "ip"], 2: ["card", "date", "date", "email"], 3: [], 4: [], 5: ["ssn", "phone", "card"], 6: ["date", "phone"], 7: ["ip"]}
    assert got[3].text is None and got[4].text == ""
    one, two, five, six = (got[i].text for i in (1, 2, 5, 6))
    card = re.search(r"or (\d{16}),", one)[1]
    assert luhn(card) and card != "4111111111111111" and f"again {card} on" in two
    assert re.sub(r"\D", "", five)[-16:] == card and re.search(r"\d{4} \d{4} \d{4} \d{4}$", five)
    day = re.search(r"on (\d{4})-(\d\d)-(\d\d) and (\d\d)/(\d\d)/(\d{4})", two)
    assert day[1] == day[6] and day[2] == day[5] and day[3] == day[4] and six.startswith("-".join(day.group(1, 2, 3)))
    ip = re.search(r"ip (\S+),", one)[1]
    assert all(0 <= int(x) <= 255 for x in ip.split(".")) and got[7].text == "lorem " * 50_000 + ip
    assert "10.0.256.3 and 4111-1111-1111-1112" in one and "2021-02-30" in two and "000-12-1234" in five and "x1.2.3.4.5 3.14159 100000000" in five
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", one) and re.match(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4} ", five)
    assert re.search(r"; [a-z]{3}\.\d\d@mail3\.example\.com$", two)
    other = {r.doc_id: r.text for r in pii.pseudonymised(docs(ROWS), "another key").collect()}
    assert other[1] != one and pii.pseudonymised(docs([]), "k").count() == 0
    with pytest.raises(ValueError):
        pii.pseudonymised(docs([]), "")


@pytest.mark.parametrize("make, values", [("_ssn", [f"{a:03d}-{g:02d}-{s:04d}" for a in (1, 665, 667, 899) for g in (1, 99) for s in (1, 2, 9999)]), ("_ip", [f"10.0.{a}.{b}" for a in range(4) for b in range(64)]), ("_phone", [f"555-123-{i:04d}" for i in range(300)]), ("_email", [f"{c}{d}.{i}@x.org" for c in "abc" for d in "xyz" for i in range(10)])])
def test_distinct_values_stay_distinct(spark, make, values):
    df = spark.createDataFrame([(v,) for v in values], "v string").select(getattr(pii, make)(F.col("v"), "k").alias("w"), "v")
    got = df.select("w", pii.kind_of(F.col("w")).alias("a"), pii.kind_of(F.col("v")).alias("b")).collect()
    assert len({r.w for r in got}) == len(values) and all(r.a == r.b for r in got)
