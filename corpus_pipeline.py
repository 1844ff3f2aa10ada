"""Corpus pipeline: toxicity, exact dedup, n-gram Jaccard join, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of documents; the
last returns the packed pieces. Rows that a stage drops leave by their ids: rows without an id stay. A stage keeps every
row that it has no reason to drop; an empty input gives an empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.llm import decontamination, exact_dedup, jaccard_join, packing, queries, toxicity
from larkspan.llm.common import written

#: Dropped ids are broadcast up to so many (8 bytes each, about 64 MB in Spark's hash table); beyond, the join shuffles.
BROADCAST_IDS = 2_000_000


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    dropped = written(dropped.select("doc_id").distinct(), "dropped")
    few = dropped.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(dropped) if few else dropped, "doc_id", "left_anti").select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(docs, queries.table(spark, sf_dir, "labels"))
    return without(docs, scored.where(F.col("score") >= queries.TOXIC_SCORE))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, exact_dedup.exact_dedup(docs).where(~F.col("kept")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, jaccard_join.jaccard_components(docs).where(F.col("doc_id") != F.col("component_id")))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, decontamination.leaks(docs, queries.table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokenised(docs, queries.TOKENIZER), with_ids=False).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard_join", drop_near_copies), ("benchmark_decontamination", drop_leaks), ("packing", pack)]
#: Tokenizer, language models and latent search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
