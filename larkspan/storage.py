"""Written tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where it is unset and the master is local."""
    own = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        own = f"file://{os.path.join(tempfile.gettempdir(), 'larkspan-shared')}"
        spark.conf.set("spark.checkpoint.dir", own)
    return own


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write as Parquet and read back."""
    path = f"{shared_dir(df.sparkSession)}/larkspan/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
