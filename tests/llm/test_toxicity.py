import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from larkspan.llm import toxicity as m

BAD = ["vilex", "grubbo", "snarf"]


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["w" + str(int(rng.random() ** 2 * 300)) for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(BAD).title())
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, docs):
    rows, labels = corpus()
    found = m.toxicity(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2} and len(found) == len(rows)
    right = sum((r.score >= 0.3) == bool(truth[r.doc_id]) for r in held)
    assert right >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in found)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    again = m.toxicity(docs(rows), spark.createDataFrame(flipped, "doc_id long, toxic int")).collect()
    assert {(r.doc_id, r.score) for r in found} == {(r.doc_id, r.score) for r in again}


def reference_counts(rows, cut):
    """Per class: counts, texts and pairs; words in front over both. ``rows``: (toxic, words), distinct."""
    c, t, f, both = ({k: Counter() for k in (0, 1)} for _ in range(4))
    pairs = {0: set(), 1: set()}
    for y, w in rows:
        own = [cut(x) for x in w if cut(x)]
        c[y].update(own)
        t[y].update(set(own))
        pairs[y].update((a, b) for a, b in zip(["", *w], w, strict=False) if cut(b))
    f = {y: Counter(cut(b) for _, b in pairs[y]) for y in pairs}
    both = Counter(cut(b) for _, b in pairs[0] | pairs[1])
    return c, {y: Counter({x: min(t[y][x], f[y][x]) for x in t[y]}) for y in t}, both


def reference_model(rows):
    """The docstring's formulas, word by word."""
    words, stems = (reference_counts(rows, cut) for cut in (lambda w: w, lambda w: w[:6] if len(w) > 6 else None))
    n = {y: sum(words[0][y].values()) for y in (0, 1)}
    seen = {y: sum(words[1][y].values()) for y in (0, 1)}
    share = seen[1] / (seen[0] + seen[1])

    def up(x, level, lower):
        c, e, both = level
        a, b = e[1][x], e[0][x]
        gain = (a * math.log(a / (a + b) / share) if a else 0) + (b * math.log(b / (a + b) / (1 - share)) if b else 0)
        w = 1 / (1 + math.exp(min(50, 0.5 * math.log(seen[0] + seen[1]) - gain)))
        shared = both[x] / sum(words[2].values())
        return [w * (max(c[y][x] - m.DISCOUNT, 0) / n[y] / shared + m.DISCOUNT * len(c[y]) / n[y] * lower[y]) + (1 - w) * lower[y] for y in (0, 1)]

    low = {s: up(s, stems, [1.0, 1.0]) for s in stems[2]}
    steps = lambda u: round(math.log(u[1] / u[0]) * m.STEPS)
    return {x: steps(up(x, words, low.get(x[:6] if len(x) > 6 else None, [1.0, 1.0]))) for x in words[2]}, {s: steps(u) for s, u in low.items()}


def labelled(spark, rows):
    return m.distinct_texts(spark.createDataFrame([(i, y, t) for i, (y, t) in enumerate(rows)], "id long, toxic long, text string").select("id", "toxic", m.words_of(F.col("text")).alias("words")))


def test_model_against_formula(spark):
    rng = random.Random(5)
    ordinary, bad = ["stone", "river", "waterfalls", "watermill", "is", "the", "mountains"], ["vilexoid", "vilexous", "grubbo"]
    rows = [(y, " ".join(rng.choice(ordinary + bad * (2 * y)) for _ in range(rng.randrange(3, 15)))) for y in (0, 0, 1) for _ in range(40)]
    rows += [(0, "only-once, here!"), (1, "Vilexoly"), rows[0], rows[-1]]
    frame = labelled(spark, rows)
    assert frame.count() == len({(y, tuple(re.findall(r"\w+", t.lower()))) for y, t in rows})
    words, stems = reference_model({(y, tuple(re.findall(r"\w+", t.lower()))) for y, t in rows})
    counts = m.word_counts(frame)
    by_word, by_stem = m.model(counts, m.stem_counts(frame, counts))
    key = {r.k: r.w for r in spark.createDataFrame([(w,) for w in {*words, *stems}], "w string").select("w", F.xxhash64("w").alias("k")).collect()}
    got, low = ({key[r.key]: r.ratio for r in t.collect()} for t in (by_word, by_stem))
    assert low == stems and got == words  # so few words that all are hot, and so listed
    assert stems["vilexo"] > 100 and words["vilexoly"] > 100 and words["grubbo"] > 100 and abs(words["once"]) < 60 and words["river"] < 0


def test_words_before_are_counted_without_a_ceiling(spark):
    rows = [(i % 2, " ".join(f"f{i * 100 + k} common" for k in range(100))) for i in range(30)] + [(0, "f0 common f0 common")]
    counts = m.word_counts(labelled(spark, rows)).where("word in ('common', 'f0', 'f7')").collect()
    assert {r.word: (r.toxic, r.ordinary, r.toxic_pairs, r.ordinary_pairs, r.before, r.toxic_texts, r.ordinary_texts) for r in counts} == {"common": (1500, 1502, 1500, 1500, 3000, 15, 16), "f0": (0, 3, 0, 2, 2, 0, 2), "f7": (0, 1, 0, 1, 1, 0, 1)}


def test_both_ways_of_joining_agree(spark, docs):
    rows, _ = corpus(80)
    texts = docs([*rows, (900, None), (901, ""), (902, "W1 vilexoid vilexium!"), (902, "w1"), (902, "w1"), (None, "w1")]).select(F.col("doc_id").alias("id"), m.text_of("text").alias("text"))
    tables = [spark.createDataFrame(t, "word string, ratio long, hot boolean").select(F.xxhash64("word").alias("key"), "ratio", "hot") for t in ([("w1", 5, True), ("vilexoid", 7, False), ("w2", -3, False)], [("vilexi", 9, False), ("vilexo", 100, True)])]
    a, b = (sorted(((r.id, r.ratio) for r in m.ratios(texts, tables, limit).collect()), key=repr) for limit in (10, 0))
    assert a == b and len(a) == len(rows) + 6 and (900, 0.0) in a and (901, 0.0) in a
    unit = lambda total, n: total / (n + m.PSEUDO_WORDS) / m.STEPS
    assert [x for i, x in a if i == 902] == sorted([unit(21, 3), unit(5, 1), unit(5, 1)], key=repr) and (None, unit(5, 1)) in a


def test_a_row_for_each_row(spark, docs):
    rows, labels = corpus(60)
    odd = [*rows, *rows[:20], (None, "w1"), (None, "w1"), (None, None), (5, "another text"), (6, "x" * 300_000 + " vilex" * 3)]
    got = m.toxicity(docs(odd), spark.createDataFrame([*labels, (None, 1)], "doc_id long, toxic int")).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in odd) and all(0 <= r.score <= 1 for r in got)
    assert all(not r.held_out for r in got if r.doc_id is None)


def test_odd_labels_and_empty_tables(spark, docs):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    assert m.toxicity(docs([]), labels([])).count() == 0
    got = m.toxicity(docs([(1, "a b"), (2, None)]), labels([(1, None), (None, 1), (1, 0), (1, 0)])).collect()
    assert len(got) == 2 and len({r.score for r in got}) == 1
