"""Spark sessions with the settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "larkspan", master: str | None = None, **settings: str) -> SparkSession:
    """A session; on a cluster the master and the sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()
