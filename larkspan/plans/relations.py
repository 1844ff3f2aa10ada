"""The engine's relations on the driver's tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.functions.scalars import file_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files; those that aren't English lie in a folder below their source's."""
    d = table(spark, sf_dir, "documents")
    own = F.col("doc_id").cast("string")
    path = F.when(F.col("lang") == "en", F.concat_ws("/", "source", own)).otherwise(F.concat_ws("/", "source", F.substring(own, 1, 1), own))
    return d.select(file_id(own).alias("id"), path.alias("path"), F.col("n_chars").cast("double").alias("duration_in_sec"), "source", "doc_id", "lang")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as segments of a user's file; time runs a thousand times as fast."""
    start = F.unix_micros(F.col("ts").cast("timestamp")) / 1e9
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("speaker"), start.alias("start"), (start + F.col("value")).alias("end"))


def speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    own = F.col("lang") == "en"
    return d.groupBy(F.col("source").alias("sp")).agg(F.sum(F.when(own, F.col("n_chars")).otherwise(0)).cast("double").alias("duration"), F.sum(F.when(own, 0).otherwise(F.col("n_chars"))).cast("double").alias("duration_non_lt"))


def language_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per six documents in a row: their (lang, conf) in order."""
    d = table(spark, sf_dir, "documents")
    each = F.struct("doc_id", "lang", ((F.col("n_chars") % 100) / 100.0).alias("conf"))
    return d.groupBy(F.floor(F.col("doc_id") / 6).alias("grp")).agg(F.transform(F.sort_array(F.collect_list(each)), lambda x: F.struct(x["lang"].alias("lang"), x["conf"].alias("conf"))).alias("found"))


FILES = "SELECT md5(CAST(doc_id AS VARCHAR)) AS id, CASE WHEN lang = 'en' THEN source || '/' || doc_id ELSE source || '/' || substr(CAST(doc_id AS VARCHAR), 1, 1) || '/' || doc_id END AS path, CAST(n_chars AS DOUBLE) AS duration_in_sec, source, doc_id, lang FROM documents"
SEGMENTS = "SELECT event_id, CAST(user_id AS VARCHAR) AS id, event_type AS speaker, epoch_us(ts) / 1e9 AS start, epoch_us(ts) / 1e9 + value AS \"end\" FROM events"
SPEAKERS = "SELECT source AS sp, CAST(sum(CASE WHEN lang = 'en' THEN n_chars ELSE 0 END) AS DOUBLE) AS duration, CAST(sum(CASE WHEN lang = 'en' THEN 0 ELSE n_chars END) AS DOUBLE) AS duration_non_lt FROM documents GROUP BY source"
