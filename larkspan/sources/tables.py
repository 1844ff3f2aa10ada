"""Scans of the stored tables, with filters that reach the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.functions.scalars import basename, file_id, has_extension, without_prefix


def scan_files(files: DataFrame, source: str = "") -> DataFrame:
    """Files of a source (all if it is empty) in path order."""
    return (files.where(F.col("source") == source) if source else files).orderBy("path", "id")


def files_of(files: DataFrame, sources: list[str]) -> DataFrame:
    return files.where(F.col("source").isin(sources))


def of_types(kv: DataFrame, *types: str) -> DataFrame:
    return kv.where(F.col("type").isin(list(types)))


def load_blobs(wanted: DataFrame, kv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blobs of the wanted (id, type), and the pairs that have none."""
    return wanted.join(kv, ["id", "type"]), wanted.join(kv.select("id", "type"), ["id", "type"], "left_anti")


def walk(spark: SparkSession, folder: str, extensions: list[str] = (), names: list[str] | None = None) -> DataFrame:
    """(path, length, modified) of files below a folder, by extension or exact name; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", F.col("modificationTime").alias("modified"))
    found = found.where(has_extension(F.col("path"), list(extensions)))
    if names is not None:
        found = found.where(basename(F.col("path")).isin([n.strip() for n in names if n.strip()]))
    return found


def read_blobs(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Artifacts below a folder as (id, type, content): type is the file's name, id its folder below ``folder``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).where(basename(F.col("path")).isin(names))
    path = F.regexp_replace(F.col("path"), "^file:/*", "/")
    below = without_prefix(path, folder.removeprefix("file://"))
    return found.select(F.regexp_replace(below, "/[^/]*$", "").alias("id"), basename(path).alias("type"), "content")


def index_files(found: DataFrame, base: str, source: str, prefix: str = "") -> DataFrame:
    """Rows for the files table: id is the md5 of the name below ``base``."""
    name = F.concat(F.lit(prefix), without_prefix(F.regexp_replace(F.col("path"), "^file:/*", "/"), base))
    return found.select(file_id(name).alias("id"), name.alias("path"), F.lit(None).cast("double").alias("duration_in_sec"), F.lit(source).alias("source"))


def key_range(tars: DataFrame, first: int, until: int) -> DataFrame:
    """Shards numbered ``first`` to ``until`` - 1 by their six-digit names."""
    number = F.try_to_number(F.regexp_extract("path", r"(\d{6})\.tar$", 1), F.lit("999999")).cast("int")
    return tars.where((number >= first) & (number < until))
