"""Runs, cut-offs, budgets, packing and splits of ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.functions.scalars import dirname
from larkspan.operators import ordered
from larkspan.operators.folds import Fold, fold


def shuffled(seed: str, *columns: str) -> Column:
    """A repeatable shuffle: order by the md5 of the seed and the key columns."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in columns]).cast("binary"))


def folder_runs(files: DataFrame) -> DataFrame:
    """``files`` with ``folder`` and ``run``: consecutive files, by path, of one folder."""
    return ordered.runs(files.withColumn("folder", dirname(F.col("path"))), ["path", "id"], "folder")


def first_of_runs(files: DataFrame, n: int) -> DataFrame:
    """The first ``n`` files (one at least) of each run of a folder."""
    turn = F.row_number().over(Window.partitionBy("run").orderBy("path", "id"))
    return folder_runs(files).withColumn("turn", turn).where(F.col("turn") <= max(n, 1))


def folder_clusters(files: DataFrame, speaker: str = "SPEAKER_00") -> DataFrame:
    """A cluster per run: (run, folder, members)."""
    member = F.struct(F.lit(speaker).alias("sp"), F.col("id").alias("f"))
    by_path = F.sort_array(F.collect_list(F.struct("path", "id", member.alias("m"))))
    return folder_runs(files).groupBy("run", "folder").agg(F.transform(by_path, lambda x: x["m"]).alias("members"))


def until_budget(rows: DataFrame, group: list[str], order: list, amount: Column, most: float) -> DataFrame:
    """Rows in order until their sum reaches ``most``; the row that crosses it is in."""
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum(amount).over(before), F.lit(0.0))).where(F.col("before") < most)


def eligible(segments: DataFrame, least: float = 0.2, least_in_file: float = 3.0) -> DataFrame:
    """Segments with a gender, of no language or Lithuanian, long enough, of speakers with enough in the file."""
    source = F.when(F.col("source") == "liepa3-speaker", "liepa3").otherwise(F.col("source"))
    own = segments.where((F.coalesce("gender", F.lit("")) != "") & F.coalesce("lang", F.lit("")).isin("", "lt")).withColumn("source", source)
    length = F.col("end") - F.col("start")
    total = F.sum(length).over(Window.partitionBy("gs", "id"))
    return own.where(length >= least).withColumn("in_file", total).where(F.col("in_file") >= least_in_file).drop("in_file")


class _Budget(Fold):
    """Short rows first, then long ones; totals are shared, each list ends on its own."""

    def __init__(self, key: tuple, take: float, caps: dict[str, float], reserve: float, capped: str):
        self.key, self.take, self.caps, self.reserve, self.capped = key, take, caps, reserve, capped
        self.total = self.crawl = 0.0
        self.over = [False, False]

    def row(self, r) -> list[tuple]:
        if self.over[bool(r.is_long)]:
            return []
        length = float(r.end) - float(r.start)
        crawl = r.source == self.capped
        if crawl and r.gender in self.caps and self.crawl + length > self.caps[r.gender]:
            return []
        if self.total + length <= self.take:
            self.total += length
            self.crawl += length * crawl
            return [(*self.key, r.seg)]
        if self.total + self.reserve > self.take:
            self.over[bool(r.is_long)] = True
        return []


def select_budget(segments: DataFrame, take: float = 3600.0, male: float = 3000.0, female: float = 3600.0, seed: str = "42", longest: float = 30.0, number: str = "seg", capped: str = "crawl", order: list | None = None) -> DataFrame:
    """Greedy choice of segments for each global speaker ``gs``; ``number`` identifies a segment."""
    rows = segments.withColumn("seg", F.col(number).cast("long")).withColumn("is_long", F.col("end") - F.col("start") > longest).withColumn("turn", shuffled(seed, number))
    caps = {"m": male, "f": female}
    chosen = fold(rows.select("gs", "seg", "is_long", "turn", "start", "end", "source", "gender", *(c for c in order or [] if c not in ("seg", "start", "end"))), ["gs"], ["is_long", *(order or ["turn", "seg"])], lambda k: _Budget(k, take, caps, longest, capped), "gs string, seg long")
    return segments.join(chosen.select(F.col("seg").alias(number)), number, "left_semi")


class _NextFit(Fold):
    def __init__(self, key: tuple, most: float):
        self.key, self.most, self.chunk, self.now, self.any = key, most, 0, 0.0, False

    def row(self, r) -> list[tuple]:
        length = float(r.end) - float(r.start)
        if self.any and self.now + length > self.most:
            self.chunk, self.now = self.chunk + 1, 0.0
        self.now, self.any = self.now + length, True
        return [(*self.key, r.path, int(r.pos), float(r.start), float(r.end), self.chunk)]


def next_fit(segments: DataFrame, most: float = 30.0) -> DataFrame:
    """Chunks of at most ``most`` seconds per source, in path order; a longer segment has a chunk of its own.

    Rows (source, path, pos, start, end) gain ``chunk``.
    """
    return fold(segments.select("source", "path", "pos", "start", "end"), ["source"], ["path", "pos"], lambda k: _NextFit(k, most), "source string, path string, pos long, start double, end double, chunk long")


def tars(chunks: DataFrame, n: int = 600) -> DataFrame:
    """``n`` chunks in a tar, in order, for each source; chunks number without gaps."""
    return chunks.withColumn("tar", F.floor(F.col("chunk") / n).cast("long"))


def cuts(chunks: DataFrame) -> DataFrame:
    """(source, chunk, path, segments): neighbouring segments of one file in a chunk share a record."""
    segment = F.struct("pos", F.struct("start", "end").alias("s"))
    return chunks.groupBy("source", "chunk", "path").agg(F.transform(F.sort_array(F.collect_list(segment)), lambda x: x["s"]).alias("segments"))


def split(rows: DataFrame, key: str, seed: str = "42", train: float = 0.95, valid: float = 0.025) -> DataFrame:
    """``part``: train, valid or test by place in a repeatable shuffle; counts are truncated, the rest is test."""
    laid = ordered.laid_out(rows.withColumn("__turn", shuffled(seed, key)), "__turn", key)
    n = laid.count()
    first, second = int(n * train), int(n * train) + int(n * valid)
    placed = ordered.row_numbers(laid, ["__turn", key], "place")
    return placed.withColumn("part", F.when(F.col("place") <= first, "train").when(F.col("place") <= second, "valid").otherwise("test")).drop("__turn", ordered.PART)


def first_n(rows: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("turn") <= n)


def sample_per_group(rows: DataFrame, group: list[str], key: str, n: int, seed: str = "42") -> DataFrame:
    return first_n(rows, group, [shuffled(seed, key), key], n)


def page(rows: DataFrame, order: list, start: int, stop: int) -> DataFrame:
    """Rows ``start`` to ``stop`` - 1."""
    return rows.orderBy(*order).offset(start).limit(max(0, stop - start))


def parse_range(text: str) -> tuple[int, int]:
    """'a:b' or 'a' as a range of row numbers."""
    parts = text.split(":")
    if not 1 <= len(parts) <= 2 or not all(p.strip().isdigit() for p in parts):
        raise ValueError(f"no range: {text!r}")
    low = int(parts[0])
    high = int(parts[1]) if len(parts) == 2 else low + 1
    if high <= low:
        raise ValueError(f"empty range: {text!r}")
    return low, high


def moving_average(audit: DataFrame, value: str, order: list, group: list[str] = (), last: int = 200) -> DataFrame:
    """Mean of the last ``last`` values up to each row."""
    return audit.withColumn("moving", F.avg(value).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(-(last - 1), 0)))
