r"""Deletion of repeated line runs with a suffix array over line ids, by distributed prefix doubling. DataFrame only.

Lines that occur once end every repeated run, so they leave first; the others get order-preserving ids. Prefix doubling
then ranks, for 1, 2, 4, ... lines, the runs that start at each position by the pair of ranks of their halves: distinct
repeated pairs are sorted over all tasks, and their places in the order are the new ranks, so that positions ordered by rank
are the suffix array to that depth. Positions leave when their run is unique or reaches its text's end, and doubling goes on
until none is left. The positions of one rank are an interval of common prefixes of that depth; a position whose interval
has an earlier member, by (id, text hash, line), is a later copy. Each position takes the deepest interval in which it is
one: its run there is deleted, and overlapping runs make up the maximal repeated ones of any length. A run counts from
``min_lines`` lines or ``min_words`` words on; between powers of two, intervals are those of pairs of overlapping runs. The
first copy of each run stays; which lines go is judged on the input as given. Without ``min_words`` only lines count.

Lines are compared without white space at their ends and with inner white space as one blank. Defined cases: a null
text counts as empty, which is one empty line; rows that repeat an id and text are judged alike and are no copies of each
other; a null id sorts before others; very long lines are compared by two 64-bit hashes; a text's deleted runs are merged as
ranges, in linear time however many they are; a line or rank that very many positions have is met by broadcast, not in one
task; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.llm.common import WS, met_by_key, text_of, without_spans, written

MIN_LINES = 3
MIN_WORDS = 50
_PLACE = ("id", "th", "line")


def line_key(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, WS, " "))


def _ranked(positions: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Positions (written) with the ``rank`` of their ``by`` values, the place in their order, and whether they are a
    ``later`` copy; where the values don't occur again, the rank is null (``how`` left) or the position is left out."""
    place = F.struct(*_PLACE)
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in by])
    again = positions.where(known).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    ranks = written(again.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id()), "line-ranks")
    total = ranks.agg(F.sum("n")).first()[0] or 0
    met = met_by_key(positions, ranks, by, "n", total, how)
    return met.withColumn("later", F.coalesce(place > F.col("first"), F.lit(False))).drop("first")


def _ahead(distance: int, what: str) -> Column:
    at = Window.partitionBy("id", "th").orderBy("line").rangeBetween(distance, distance)
    return F.first(what).over(at)


def _summed(positions: DataFrame) -> DataFrame:
    """Words before and through each position, over the positions given; a position that stands twice counts once."""
    at = Window.partitionBy("id", "th").orderBy("line")
    once = positions.withColumn("once", F.when(F.lag("line").over(at) == F.col("line"), F.lit(0)).otherwise(F.col("words")))
    return once.withColumn("through", F.sum("once").over(at)).withColumn("before", F.col("through") - F.col("words")).drop("once", "words")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    own = docs.select(F.col(id_col).cast("long").alias("own"), F.split(text_of(text_col), "\n").alias("lines"))
    return own.withColumn("id", F.coalesce("own", F.lit(-1 << 63))).withColumn("th", F.xxhash64("lines"))


def later_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """(id, th, line, length): for each position that starts a later copy of a run, that of the deepest interval."""
    lines = docs.select("id", "th", F.posexplode("lines").alias("line", "raw")).withColumn("key", line_key(F.col("raw")))
    n_words = F.when(F.col("key") == "", F.lit(0)).otherwise(F.size(F.split("key", " "))).cast("long")
    own = lines.select(*_PLACE, F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), n_words.alias("words"))
    now = _ranked(written(own, "lines"), ["h1", "h2"]).drop("h1", "h2")
    length, found = 1, []
    by_words = min_words is not None
    now = written(_summed(now) if by_words and min_lines > 1 else now.drop("words"), "line-positions")
    while True:
        short = length < min_lines and by_words
        # pairs of halves; a null half is beyond the text or a run that occurs once
        pairs = now.withColumnsRenamed({"rank": "a", "later": "is_later"}).withColumn("b", _ahead(length, "a"))
        deeper = written(_ranked(written(pairs, "line-pairs"), ["a", "b"], "left"), "line-positions")
        ends = deeper.where(~F.col("later"))  # no later copy at twice the depth
        if length >= min_lines:
            found.append(ends.where("is_later").select(*_PLACE, F.lit(length).alias("length")))
        else:
            for n in range(length, min(2 * length - 1, min_lines) + 1):
                if n < min_lines and not by_words:
                    continue
                runs = deeper.drop("b", "rank").withColumnRenamed("later", "goes_on")
                if n > length:
                    last = {"c": _ahead(n - length, "a")} | ({"through": _ahead(n - length, "through")} if short else {})
                    runs = _ranked(written(runs.drop("is_later").withColumns(last).where("c is not null"), "line-runs"), ["a", "c"]).withColumnRenamed("later", "is_later")
                if n < min_lines:
                    runs = runs.where(F.col("through") - F.col("before") >= min_words)
                found.append(runs.where("is_later and not goes_on").select(*_PLACE, F.lit(n).alias("length")))
        now = deeper.where("rank is not null").drop("a", "b", "is_later")
        if now.isEmpty():
            return reduce(DataFrame.unionAll, found) if found else now.select(*_PLACE, F.lit(0).alias("length"))
        if short:  # words up to the end of a run of twice the lines
            now = written(deeper.withColumn("through", _ahead(length, "through")).where("rank is not null").drop("a", "b", "is_later"), "line-positions")
        length *= 2


def deleted_spans(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """(id, th, lows, highs): the maximal runs of lines [low, high) that later copies cover, in each document that has any."""
    runs = later_runs(docs, min_lines, min_words).select("id", "th", F.col("line").alias("low"), (F.col("line") + F.col("length")).alias("high"))
    at = Window.partitionBy("id", "th").orderBy("low", "high")
    open_end = F.max("high").over(at.rowsBetween(Window.unboundedPreceding, -1))
    parts = runs.withColumn("fresh", (open_end.isNull() | (F.col("low") > open_end)).cast("int")).withColumn("part", F.sum("fresh").over(at))
    spans = parts.groupBy("id", "th", "part").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ranges = F.sort_array(F.collect_list(F.struct("low", "high")))
    return spans.groupBy("id", "th").agg(ranges.alias("ranges")).select("id", "th", F.col("ranges.low").alias("lows"), F.col("ranges.high").alias("highs"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """Per document: id, n_lines, n_removed, n_runs (maximal deleted runs), text (kept lines joined by line feeds)."""
    own = _keyed(docs, id_col, text_col)
    met = own.join(deleted_spans(own, min_lines, min_words), ["id", "th"], "left")
    none = F.col("lows").isNull()
    removed = F.aggregate(F.arrays_zip("lows", "highs"), F.lit(0), lambda n, s: n + s["highs"] - s["lows"])
    kept = F.when(none, F.array_join("lines", "\n")).otherwise(F.array_join(without_spans(F.col("lines"), F.col("lows"), F.col("highs")), "\n"))
    count = lambda x: F.when(none, 0).otherwise(x).cast("long")
    return met.select(F.col("own").alias(id_col), F.size("lines").cast("long").alias("n_lines"), count(removed).alias("n_removed"), count(F.size("lows")).alias("n_runs"), kept.alias("text"))
