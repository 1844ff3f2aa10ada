"""Aggregations and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CAPS_HOURS = (1, 2, 5, 10, 20, 50, 100, 200, 100000)


def totals(rows: DataFrame, value: Column, prefix: str = "") -> DataFrame:
    """Sum, median, mean and number of a value."""
    v = rows.select(value.cast("double").alias("v"))
    return v.agg(F.sum("v").alias(f"{prefix}total"), F.median("v").alias(f"{prefix}median"), F.avg("v").alias(f"{prefix}mean"), F.count("v").alias(f"{prefix}n"))


def positive_totals(rows: DataFrame, value: str) -> DataFrame:
    return rows.where(F.col(value) > 0).agg(F.sum(value).alias("total"), F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))


def top_sums(rows: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The ``n`` keys with the greatest sums of positive values; equal sums by key."""
    return rows.where(F.col(value) > 0).groupBy(key).agg(F.sum(value).alias("total")).orderBy(F.desc("total"), key).limit(n)


def cap_sweep(rows: DataFrame, value: Column, caps: tuple[float, ...], unit: float = 3600.0) -> DataFrame:
    """For each cap, over the positive values: the capped sum, how many are over it, what the cap cuts off, and how many there
    are; one pass over the rows."""
    v, cap = F.col("v"), lambda h: F.lit(float(h) * unit)
    own = rows.select(value.cast("double").alias("v")).where("v > 0")
    one = own.agg(*[x for i, h in enumerate(caps) for x in (F.sum(F.least(v, cap(h))).alias(f"c{i}"), F.count_if(v > cap(h)).alias(f"o{i}"))], F.sum("v").alias("all"), F.count("v").alias("n"))
    packed = F.array(*[F.struct(F.lit(float(h)).alias("cap"), F.col(f"c{i}").alias("capped"), F.col(f"o{i}").alias("over"), (F.col("all") - F.col(f"c{i}")).alias("trimmed"), F.col("n").alias("n")) for i, h in enumerate(caps)])
    return one.select(F.inline(packed))


def speaker_durations(segments: DataFrame, keys: list[str] = ("file_id", "speaker")) -> DataFrame:
    return segments.groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias("duration_in_sec"), F.count(F.lit(1)).cast("int").alias("segments"))


def split_durations(members: DataFrame, file_speakers: DataFrame, cluster: str = "cluster", own: str = "lt") -> DataFrame:
    """Per cluster: the duration of members in the own language and that of all others; members without a row count 0."""
    met = members.join(file_speakers.select(F.col("file_id").alias("f"), F.col("speaker").alias("sp"), "duration_in_sec", "language"), ["f", "sp"], "left")
    is_own = F.coalesce(F.rtrim("language") == own, F.lit(False))
    length = F.coalesce(F.col("duration_in_sec").cast("double"), F.lit(0.0))
    return met.groupBy(cluster).agg(F.sum(F.when(is_own, length).otherwise(0.0)).alias("duration"), F.sum(F.when(is_own, 0.0).otherwise(length)).alias("duration_non_lt"))


def source_gender_stats(segments: DataFrame) -> DataFrame:
    """Duration, segments and distinct speakers per (source, gender) and, with source null, per gender; hours as trained
    on: crawled ones count fourfold."""
    length = F.col("end") - F.col("start")
    rolled = segments.withColumn("__s", length).groupingSets([[F.col("source"), F.col("gender")], [F.col("gender")]], F.col("source"), F.col("gender")).agg(F.sum("__s").alias("duration"), F.sum(F.when(F.col("source") == "crawl", F.col("__s") * 4).otherwise(F.col("__s"))).alias("augmented"), F.count(F.lit(1)).alias("segments"), F.count_distinct("gs").alias("speakers"), F.grouping("source").alias("level"))
    return rolled


def grand_totals(stats: DataFrame) -> DataFrame:
    """Sums over the (source, gender) rows; a speaker of several groups counts in each."""
    return stats.where("level = 0").agg(F.sum("duration").alias("duration"), F.sum("segments").alias("segments"), F.sum("speakers").alias("speakers"))


def label_sums(segments: DataFrame, labels: tuple[str, ...] = ("music", "speech", "noEnergy", "noise"), key: str | None = None) -> DataFrame:
    """Seconds of each label, in a column each."""
    grouped = segments.groupBy(*([key] if key else [])).pivot("label", list(labels)).agg(F.sum(F.col("end") - F.col("start")))
    return grouped.fillna(0.0, list(labels))


def total_of_results(results: DataFrame, value: str = "result") -> DataFrame:
    """Sum of the results that are ok, and the numbers of both kinds."""
    return results.agg(F.sum(F.when(F.col("ok"), F.col(value))).alias("total"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"))


def histogram(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin, low, n, running): equal widths from the least value on; the greatest one has a bin of its own, ``bins``. If all
    values are equal there is one bin."""
    ends = rows.agg(F.min(value).cast("double").alias("__low"), F.max(value).cast("double").alias("__high"))
    width = (F.col("__high") - F.col("__low")) / bins
    at = F.when(width > 0, F.floor((F.col(value).cast("double") - F.col("__low")) / width)).otherwise(F.lit(0)).cast("long")
    counted = rows.where(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).select(at.alias("bin"), (F.col("__low") + at * width).alias("low")).groupBy("bin").agg(F.min("low").alias("low"), F.count(F.lit(1)).alias("n"))
    return counted.withColumn("running", F.sum("n").over(Window.orderBy("bin")))  # at most bins + 1 rows


def within_size(files: DataFrame, suffix: str, megabytes: float) -> tuple[DataFrame, DataFrame]:
    """Files of a suffix under a size, and one row with the number of larger ones."""
    own = files.where(F.col("path").endswith(suffix))
    limit = megabytes * (1 << 20)
    return own.where(F.col("length") < limit), own.agg(F.count_if(F.col("length") >= limit).alias("skipped"))


def cluster_sizes(members: DataFrame, cluster: str = "cluster", top: int = 30) -> DataFrame:
    """(size, clusters) of the ``top`` largest sizes and of single members."""
    sizes = members.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    spread = sizes.groupBy("size").agg(F.count(F.lit(1)).alias("clusters"))
    largest = spread.orderBy(F.desc("size")).limit(top)
    return largest.union(spread.where("size = 1")).distinct()


def counts_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def progress(audit: DataFrame, total: int) -> DataFrame:
    """Rows per status, and their share of the work in percent."""
    return counts_by(audit, "status").withColumn("percent", F.when(F.lit(total) > 0, F.round(F.col("n") * 100.0 / F.lit(max(total, 1)), 2)).otherwise(F.lit(0.0)))
