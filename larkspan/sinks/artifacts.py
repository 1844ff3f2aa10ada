"""Text artifacts: JSON lines, RTTM, TextGrid, manifests; and their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, rounded: list[str] = (), places: int = 3, mode: str = "errorifexists") -> None:
    df.withColumns({c: F.round(c, places) for c in rounded}).write.mode(mode).json(path)


def append_label(df: DataFrame, path: str) -> None:
    write_jsonl(df, path, mode="append")


def collect_jsonl(files: DataFrame, kv: DataFrame, name: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Lines of every file's blob ``name`` parsed by ``schema`` and stamped with ``f``; and the files without one.

    A malformed line fails the job.
    """
    blobs = kv.where(F.col("type") == name)
    lines = files.select("id").join(blobs, "id").select("id", F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")).where(F.trim("line") != "")
    parsed = lines.select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("r"), F.col("id").alias("f"))
    return parsed.select("r.*", "f"), files.join(blobs.select("id"), "id", "left_anti")


def rttm_text(segments: DataFrame, key: str = "id", uri: str = "waveform") -> DataFrame:
    """(key, content): a line per segment, by start."""
    number = lambda c: F.format_string("%.3f", c)
    line = F.concat_ws(" ", F.lit("SPEAKER"), F.lit(uri), F.lit("1"), number(F.col("start")), number(F.col("end") - F.col("start")), F.lit("<NA>"), F.lit("<NA>"), "speaker", F.lit("<NA>"), F.lit("<NA>"))
    rows = segments.select(key, F.struct("start", "end", "speaker", line.alias("line")).alias("s"))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list("s")), lambda s: F.concat(s["line"], F.lit("\n"))), "").alias("content"))


def vad_to_rttm(vad: DataFrame, speaker: str = "SPEAKER_00", key: str = "id") -> DataFrame:
    return rttm_text(vad.withColumn("speaker", F.lit(speaker)), key)


def textgrid(segments: DataFrame, marks: DataFrame, key: str = "id") -> DataFrame:
    """(key, content): an interval tier per speaker and one, SM, of ``marks`` (label, start, end)."""
    rows = segments.select(key, F.col("speaker").alias("tier"), F.lit(0).alias("rank"), "start", "end", F.col("speaker").alias("text")).unionByName(marks.select(key, F.lit("SM").alias("tier"), F.lit(1).alias("rank"), "start", "end", F.col("label").alias("text")))
    tiers = rows.groupBy(key, "rank", "tier").agg(F.sort_array(F.collect_list(F.struct("start", "end", "text"))).alias("intervals"))
    end = F.max("high").alias("high")
    files = tiers.withColumn("high", F.array_max(F.transform("intervals", lambda x: x["end"])) + 0.01).groupBy(key).agg(end, F.sort_array(F.collect_list(F.struct("rank", "tier", "intervals"))).alias("tiers"))
    num = lambda c: c.cast("string")

    def interval(x: Column, i: Column) -> Column:
        return F.concat(F.lit("        intervals ["), num(i + 1), F.lit("]:\n            xmin = "), num(x["start"]), F.lit("\n            xmax = "), num(x["end"]), F.lit('\n            text = "'), x["text"], F.lit('"\n'))

    def tier(t: Column, i: Column) -> Column:
        head = F.concat(F.lit("    item ["), num(i + 1), F.lit(']:\n        class = "IntervalTier"\n        name = "'), t["tier"], F.lit('"\n        xmin = 0\n        xmax = '), num(F.col("high")), F.lit("\n        intervals: size = "), num(F.size(t["intervals"])), F.lit("\n"))
        return F.concat(head, F.array_join(F.transform(t["intervals"], interval), ""))

    body = F.array_join(F.transform("tiers", tier), "")
    return files.select(key, F.concat(F.lit('File type = "ooTextFile"\nObject class = "TextGrid"\n\nxmin = 0\nxmax = '), num(F.col("high")), F.lit("\ntiers? <exists>\nsize = "), num(F.size("tiers")), F.lit("\nitem []:\n"), body).alias("content"))


def manifest(rows: DataFrame, root: str) -> DataFrame:
    """(line): the root folder, then relative path and samples of each file, in path order."""
    head = rows.sparkSession.range(1).select(F.lit("").alias("path"), F.lit(root).alias("line"))
    body = rows.select("path", F.concat_ws("\t", "path", F.col("nsamples").cast("string")).alias("line"))
    return head.unionByName(body).orderBy("path").select("line")


def scp(rows: DataFrame) -> DataFrame:
    return rows.orderBy("name").select(F.concat_ws(" ", "name", "path").alias("line"))


def unit_dictionary(spark, n: int) -> DataFrame:
    return spark.range(n).orderBy("id").select(F.concat(F.col("id").cast("string"), F.lit(" 1")).alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("line").write.text(path)
