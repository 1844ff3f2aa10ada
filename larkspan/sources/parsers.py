"""Parsers of text artifacts, as column expressions and explodes; every shape has its schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan import schemas


def decoded(content: Column) -> Column:
    return F.decode(content, "UTF-8")


def lines_of(df: DataFrame, content: Column) -> DataFrame:
    """A row per line that isn't blank, with its number."""
    return df.select("*", F.posexplode(F.split(content, "\n")).alias("line_no", "line")).where(F.trim("line") != "")


def parse_rttm(df: DataFrame, content: Column, keep: list[str] = ("id",), uri: str | None = None) -> DataFrame:
    """(keep..., uri, speaker, start, end, line_no): lines of eight fields or more that are no comments."""
    fields = F.split(F.trim("line"), r"\s+")
    rows = lines_of(df, content).where(~F.trim("line").startswith("#")).withColumn("__f", fields).where(F.size("__f") >= 8)
    start = F.col("__f")[3].cast("double")
    out = rows.select(*keep, F.col("__f")[1].alias("uri"), F.col("__f")[7].alias("speaker"), start.alias("start"), (start + F.col("__f")[4].cast("double")).alias("end"), "line_no")
    return out if uri is None else out.where(F.col("uri") == uri)


def labelled_segments(content: Column) -> Column:
    """Segments of ["label", start, end] arrays that follow each other with or without separators."""
    pattern = r'\[\s*"([^"]*)"\s*,\s*(\d+(?:\.\d+)?)\s*,\s*(\d+(?:\.\d+)?)\s*\]'
    part = lambda i: F.regexp_extract_all(content, F.lit(pattern), F.lit(i))
    return F.zip_with(part(1), F.arrays_zip(part(2).alias("a"), part(3).alias("b")), lambda label, x: F.struct(label.alias("label"), x["a"].cast("double").alias("start"), x["b"].cast("double").alias("end")))


def parse_segments(df: DataFrame, content: Column, keep: list[str] = ("id",)) -> DataFrame:
    return df.select(*keep, F.posexplode(labelled_segments(content)).alias("line_no", "s")).select(*keep, "line_no", "s.*")


def parse_vad(df: DataFrame, content: Column, keep: list[str] = ("id",)) -> DataFrame:
    parsed = F.from_json(content, schemas.VAD)
    return df.select(*keep, F.posexplode(parsed).alias("line_no", "s")).select(*keep, "line_no", F.col("s.from").alias("start"), F.col("s.to").alias("end"))


def parse_embeddings(df: DataFrame, content: Column, keep: list[str] = ("id",)) -> DataFrame:
    """(keep..., sp, emb): the last line of a speaker counts."""
    rows = lines_of(df, content).select(*keep, "line_no", F.from_json("line", schemas.EMBEDDING).alias("e"))
    return rows.groupBy(*keep, F.col("e.sp").alias("sp")).agg(F.max_by("e.emb", "line_no").alias("emb"))


def parse_languages(df: DataFrame, content: Column, keep: list[str] = ("id",)) -> DataFrame:
    """(keep..., speaker, lang_res)."""
    return lines_of(df, content).select(*keep, F.from_json("line", schemas.SPEAKER_LANGUAGE).alias("l")).select(*keep, "l.speaker", "l.lang_res")


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """One object a line; blank lines are skipped; a malformed line fails if ``strict``, else it is dropped."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_clusters(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """(line, at, sp, f, pos) of the members of clusters, one array a line; ``line`` as it stands, for its name, and ``at``
    rising with it.

    ``skip`` leaves out clusters by their line's place in a single file, for resuming.
    """
    rows = spark.read.text(path, wholetext=False).select(F.col("value").alias("line"), F.monotonically_increasing_id().alias("at"))
    rows = rows.where((F.trim("line") != "") & (F.col("at") >= skip))
    return rows.select("line", "at", F.posexplode(F.from_json("line", schemas.MEMBERS)).alias("pos", "m")).select("line", "at", "m.sp", "m.f", "pos")


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON document."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def jsonl_with_path(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """Lines of all files of a name below a folder, with each file's path as ``f``."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", name).json(folder).withColumn("f", F.col("_metadata.file_path"))


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Lookup lists: (name, value) of lines 'name value'; value null where there is none."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(parts[0].alias("name"), F.try_element_at(parts, F.lit(2)).cast("double").alias("value"))


def with_absent(codecs: DataFrame) -> DataFrame:
    """As many ('none', 0) rows as there are codecs, so that half of the choices change nothing."""
    return codecs.unionAll(codecs.select(F.lit("none").alias("name"), F.lit(0.0).alias("value")))
