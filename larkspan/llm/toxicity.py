r"""Toxicity by class-conditional Kneser-Ney models.

Each class has a Kneser-Ney model of its words (runs of letters, marks and digits, lower case). Its history is the class; a
word backs off to its stem (the first ``STEM`` letters), and the stem to the continuation counts that both classes share,
the numbers of different words before a word. With ``D`` the discount, ``c`` the counts of a class, ``N`` their sum and ``T``
the types of that class, the discounted estimate at each level is ``max(c(x) - D, 0) / N + D * T / N * lower(x)``.

How far a level is trusted depends on its evidence: ``w = 1 / (1 + exp(penalty - G))`` is the posterior probability that
the classes use ``x`` at different rates, where ``G`` is the log-likelihood gained by a rate for each class and ``penalty``
is half the log of all evidence (the Bayesian information criterion). The level gets the weight ``w`` and the lower one
``1 - w``, so an expression seen once moves a score a little, one seen in many texts fully, and the small chance differences
of very many ordinary words don't drown the few telling ones. Evidence of ``x`` in a class is the smaller of the numbers of
texts and of different (word in front, word) pairs with it: neither a family of near copies nor one repetitive text makes
much of it. Equal texts count once. Every word of both classes takes part; there is no list and no threshold.

A text's score is the logistic of its length-normalised difference of the two log-likelihoods (divided by the number of
words plus ``PSEUDO_WORDS`` unknown ones), with the intercept and slope fitted on labelled rows that gave no counts, from a
histogram of their ratios (a fixed number of bins, all rows). Log ratios of words are kept in steps of 1 / ``STEPS``; a word
whose ratio is that of its stem needs no row of its own.

Counts come from every labelled row of the training folds and grow with them. The tables of words and stems are broadcast
only while their row counts are under ``BROADCAST_ROWS``; beyond that, each text's distinct words meet them in shuffled
joins, but for the words that make up at least a ``HOT``-th of all counts (so ``HOT`` rows at most), which are broadcast.

Defined cases: there is one row per input row, also for repeated and null ids; a null or empty text has a ratio of 0; null
or repeated labels: a document is toxic if any label says so, and null labels count as none; without labels of both classes
every score is the base rate; a null id is in no fold; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import text_of, written

DISCOUNT = 0.75
#: Letters of a stem.
STEM = 6
PSEUDO_WORDS = 50
#: Steps of a log ratio of 1.
STEPS = 256
#: About 40 bytes a row in Spark's hash table: 80 MB at most.
BROADCAST_ROWS = 2_000_000
HOT = 100_000
#: Labels of three numbers each, broadcast to the texts only up to so many (about 40 MB); beyond, texts are shuffled.
LABEL_ROWS = 1_000_000
BINS = 4096
#: Ratios outside of this range go to the outer bins.
SPAN = 8.0
_CLASSES = ("ordinary", "toxic")


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4."""
    return (F.crc32(F.col(id_col).cast("string").cast("binary")) % 4).cast("int")


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def stem_of(word: Column) -> Column:
    """The word's stem; null for a word that is no longer than that."""
    return F.when(F.length(word) > STEM, F.substring(word, 1, STEM))


def distinct_texts(labelled: DataFrame) -> DataFrame:
    """(toxic, words) of ``(id, toxic, words)`` rows, equal texts of a class once: that with the smallest id."""
    keyed = labelled.withColumn("text_key", F.xxhash64("words"))
    first = written(keyed.groupBy("toxic", "text_key").agg(F.min("id").alias("id")), "first-texts")
    met = keyed.join(F.broadcast(first) if first.count() <= LABEL_ROWS else first, ["toxic", "text_key", "id"])
    return met.select("toxic", "id", "words")


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, toxic, ordinary, toxic_texts, ordinary_texts, toxic_pairs, ordinary_pairs, before) over (toxic, words) rows.

    ``pairs``: different words in front, in a class; ``before``: in both.
    """
    ordinary = lambda c: F.sum(1 - F.col(c))
    front = F.concat(F.array(F.lit("")), F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))))
    rows = texts.select("toxic", F.explode(F.arrays_zip(F.col("words").alias("word"), front.alias("front"))).alias("p"))
    pairs = rows.select("toxic", F.col("p.word").alias("word"), F.xxhash64("p.front").alias("front")).groupBy("word", "front").agg(F.sum("toxic").alias("toxic"), ordinary("toxic").alias("ordinary"))
    counts = pairs.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"), *[F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_pairs") for c in _CLASSES], F.count(F.lit(1)).alias("before"))
    return counts.join(_texts_with(texts, F.col("words")), "word")


def _texts_with(texts: DataFrame, what: Column) -> DataFrame:
    each = texts.select("toxic", F.explode(F.array_distinct(what)).alias("word"))
    return each.groupBy("word").agg(F.sum("toxic").alias("toxic_texts"), F.sum(1 - F.col("toxic")).alias("ordinary_texts"))


def stem_counts(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """The same columns by stem, for the words that have one."""
    own = counts.withColumn("word", stem_of(F.col("word"))).where("word is not null").groupBy("word")
    sums = own.agg(*[F.sum(c).alias(c) for c in ("toxic", "ordinary", "toxic_pairs", "ordinary_pairs", "before")])
    return sums.join(_texts_with(texts, F.filter(F.transform("words", stem_of), lambda s: s.isNotNull())), "word")


def _evidence(c: str) -> Column:
    return F.least(F.col(f"{c}_texts"), F.col(f"{c}_pairs")).cast("double")


def _totals(counts: DataFrame) -> dict[str, float]:
    sums = {f"{c}_n": F.sum(c) for c in _CLASSES} | {f"{c}_types": F.sum((F.col(c) > 0).cast("long")) for c in _CLASSES}
    sums |= {f"{c}_evidence": F.sum(_evidence(c)) for c in _CLASSES} | {"before": F.sum("before")}
    return {k: x or 0 for k, x in counts.agg(*[x.alias(k) for k, x in sums.items()]).first().asDict().items()}


def _level(counts: DataFrame, own: dict[str, float], all_words: dict[str, float], lower: dict[str, Column]) -> DataFrame:
    """``counts`` with up_toxic and up_ordinary: each class's probability of a word over the shared one."""
    a, b = _evidence("toxic"), _evidence("ordinary")
    pa = all_words["toxic_evidence"] / (all_words["toxic_evidence"] + all_words["ordinary_evidence"])
    gain = lambda x, rate: F.when(x > 0, x * F.log(x / (a + b) / rate)).otherwise(0.0)
    penalty = 0.5 * math.log(all_words["toxic_evidence"] + all_words["ordinary_evidence"])
    trust = 1 / (1 + F.exp(F.least(F.lit(50.0), penalty - gain(a, pa) - gain(b, 1 - pa))))
    out = counts.withColumn("trust", trust).withColumn("shared", F.col("before") / F.lit(all_words["before"]))
    for c in _CLASSES:
        freed = DISCOUNT * own[f"{c}_types"] / all_words[f"{c}_n"]
        estimate = F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / all_words[f"{c}_n"] / F.col("shared") + freed * lower[c]
        out = out.withColumn(f"up_{c}", F.col("trust") * estimate + (1 - F.col("trust")) * lower[c])
    return out


def _steps(over: str = "") -> Column:
    return F.round(F.log(F.col(f"{over}up_toxic") / F.col(f"{over}up_ordinary")) * STEPS).cast("long")


def model(counts: DataFrame, stems: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(key, ratio, hot) of words and of stems: ``STEPS`` times the log-likelihood ratio, as a long; words that have their
    stem's ratio (0 without a stem) and stems with a ratio of 0 are not listed, unless hot. None if a class has no words."""
    total = _totals(counts)
    if not total["toxic_n"] or not total["ordinary_n"]:
        return None
    one = {c: F.lit(1.0) for c in _CLASSES}
    hot = (F.col("toxic") + F.col("ordinary")) * HOT >= total["toxic_n"] + total["ordinary_n"]
    by_stem = written(_level(stems, _totals(stems), total, one).select(F.col("word").alias("stem"), hot.alias("hot"), *[F.col(f"up_{c}").alias(f"low_{c}") for c in _CLASSES], _steps().alias("stem_ratio")), "toxic-stems")
    met = counts.withColumn("stem", stem_of(F.col("word"))).join(by_stem.drop("hot"), "stem", "left")
    words = _level(met, total, total, {c: F.coalesce(f"low_{c}", F.lit(1.0)) for c in _CLASSES})
    words = words.select(F.xxhash64("word").alias("key"), _steps().alias("ratio"), F.coalesce("stem_ratio", F.lit(0)).alias("stem_ratio"), hot.alias("hot"))
    return words.where("ratio <> stem_ratio or hot").drop("stem_ratio"), by_stem.where("stem_ratio <> 0 or hot").select(F.xxhash64("stem").alias("key"), F.col("stem_ratio").alias("ratio"), "hot")


def _looked_up(words: DataFrame, table: DataFrame, key: str, wanted: Column, few: bool) -> DataFrame:
    """``words`` with the ``ratio`` of the ``wanted`` ones that have a row in ``table``; the others keep what they have."""
    met = words.join(F.broadcast((table if few else table.where("hot")).select(F.col("key").alias(key), F.col("ratio").alias("found"))), key, "left")
    met = met.withColumn("ratio", F.when(wanted, F.col("found")).otherwise(F.col("ratio"))).drop("found")
    if few:
        return met
    # Words that need no row, hot ones among them, are spread over all tasks.
    met = met.withColumn("live", wanted & F.col("ratio").isNull())
    met = met.withColumn("at", F.when(F.col("live"), F.col(key)).otherwise(F.xxhash64("id", "text_key", "word_key")))
    cold = table.where("not hot").select(F.col("key").alias("at"), F.lit(True).alias("live"), F.col("ratio").alias("found"))
    return met.join(cold.hint("merge"), ["at", "live"], "left").withColumn("ratio", F.coalesce("ratio", "found")).drop("at", "live", "found")


def ratios(texts: DataFrame, tables: tuple[DataFrame, DataFrame] | None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(id, ratio), a row for each of ``texts`` (id, text): the length-normalised log-likelihood ratio of its words.

    Sums are of whole numbers, so they don't depend on the order of rows or on the way of joining.
    """
    if tables is None:
        return texts.select("id", F.lit(0.0).alias("ratio"))
    by_word, by_stem = tables
    few = by_word.count() <= broadcast_rows and by_stem.count() <= broadcast_rows
    # Rows of equal id and text are scored together: ``first`` tells how many there are.
    own = texts.select("id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))  # before words are rows
    own = own.select("id", "text_key", F.posexplode_outer("words").alias("place", "word"))
    stem = stem_of(F.col("word"))
    own = own.select("id", "text_key", (F.coalesce("place", F.lit(0)) == 0).cast("long").alias("first"), F.xxhash64("word").alias("word_key"), F.when(stem.isNotNull(), F.xxhash64(stem)).alias("stem_key"), F.col("word").isNotNull().cast("long").alias("n"))
    if not few:
        own = own.groupBy("id", "text_key", "word_key", "stem_key").agg(F.sum("first").alias("first"), F.sum("n").alias("n"))
    met = _looked_up(own.withColumn("ratio", F.lit(None).cast("long")), by_word, "word_key", F.lit(True), few)
    met = _looked_up(met, by_stem, "stem_key", F.col("ratio").isNull() & F.col("stem_key").isNotNull(), few)
    sums = met.groupBy("id", "text_key").agg(F.sum(F.coalesce("ratio", F.lit(0)) * F.col("n")).alias("total"), F.sum("n").alias("n"), F.sum("first").alias("rows"))
    ratio = F.col("total") / (F.col("n") + PSEUDO_WORDS * F.col("rows")) / STEPS
    return sums.select("id", ratio.alias("ratio"), F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))).select("id", "ratio")


def calibration(scored: DataFrame) -> tuple[float, float]:
    """Intercept and slope of a logistic curve over (ratio, toxic) rows, by Newton steps on their histogram."""
    at = F.least(F.greatest(F.floor((F.col("ratio") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    bins = scored.groupBy(at.alias("bin")).agg(F.sum("ratio").alias("x"), F.sum("toxic").alias("y"), F.count(F.lit(1)).alias("n")).collect()  # at most BINS rows
    if not bins:
        return math.log(0.05 / 0.95), 0.0
    n, y = np.array([b["n"] for b in bins], float), np.array([b["y"] for b in bins], float)
    x = np.array([b["x"] for b in bins]) / n
    rate = (y.sum() + 0.5) / (n.sum() + 1)
    beta = np.array([math.log(rate / (1 - rate)), 0.0])
    if not 0 < y.sum() < n.sum() or np.ptp(x) == 0:
        return float(beta[0]), 0.0
    unit = max(1e-9, math.sqrt(float((n * (x - (n * x).sum() / n.sum()) ** 2).sum() / n.sum())))
    z = np.stack([np.ones_like(x), x / unit], axis=1)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (y - n * p) - 1e-3 * np.array([0, beta[1]])
        step = np.linalg.solve(z.T @ (z * (n * p * (1 - p))[:, None]) + 1e-3 * np.eye(2), slope)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(max(0.0, beta[1]) / unit)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 2, calibrating: int = 3) -> DataFrame:
    """Per document: id, held_out, score (0 to 1), ratio. Fold ``held_out`` teaches nothing; fold ``calibrating``
    fits the curve; the others give the counts."""
    own = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max((F.col(label_col) > 0).cast("long")).alias("toxic")).withColumn("fold", fold("id"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    teaching = written(own, "labels").where(~F.col("fold").isin(held_out, calibrating))
    taught = texts.join(F.broadcast(teaching) if teaching.count() <= LABEL_ROWS else teaching, "id")
    taught = distinct_texts(taught.select("id", "toxic", words_of(F.col("text")).alias("words")))
    counts = written(word_counts(taught), "word-counts")
    tables = model(counts, written(stem_counts(taught, counts), "stem-counts"))
    tables = tuple(written(t, "toxic-ratios") for t in tables) if tables is not None else None
    scored = written(ratios(texts, tables), "toxic-scores")
    intercept, slope = calibration(scored.join(own.where(F.col("fold") == calibrating), "id"))
    score = 1 / (1 + F.exp(-F.least(F.greatest(intercept + slope * F.col("ratio"), F.lit(-50.0)), F.lit(50.0))))
    return scored.select(F.col("id").alias(id_col), F.coalesce(fold("id") == held_out, F.lit(False)).alias("held_out"), score.alias("score"), "ratio")
