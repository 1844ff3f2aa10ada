"""Operations over one total order of all rows, without a single-task window.

Rows are range-partitioned and written once, so that each part is a run of the order; what crosses parts is one row per part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.storage import written

PART = "__part"


def laid_out(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with the number of their part; parts follow each other in the order of ``keys``."""
    return written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(PART, F.spark_partition_id()), "ordered")


def _before(parts: DataFrame, column: str) -> DataFrame:
    """(part, before): the sum of ``column`` over earlier parts; a row for each part."""
    own = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(PART, F.coalesce(F.sum(column).over(own), F.lit(0)).alias("__before"))


def running_sum(laid: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` (a whole number) over all rows up to and with the current one."""
    rows = laid.withColumn("__v", value)
    parts = rows.groupBy(PART).agg(F.sum("__v").alias("__v"))
    own = Window.partitionBy(PART).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(F.broadcast(_before(parts, "__v")), PART).withColumn(name, F.sum("__v").over(own) + F.col("__before")).drop("__v", "__before")


def row_numbers(laid: DataFrame, keys: list[str], name: str = "row") -> DataFrame:
    return running_sum(laid, keys, F.lit(1), name)


def previous(laid: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``value`` of the row before, across parts; null on the first row."""
    own = Window.partitionBy(PART).orderBy(*keys)
    last = laid.groupBy(PART).agg(F.max_by(value, F.struct(*keys)).alias("__last"))
    carried = last.select((F.lead(PART).over(Window.orderBy(PART))).alias(PART), "__last").where(f"{PART} is not null")  # a row for each part
    rows = laid.withColumn("__turn", F.row_number().over(own)).join(F.broadcast(carried), PART, "left")
    return rows.withColumn(name, F.when(F.col("__turn") == 1, F.col("__last")).otherwise(F.lag(value).over(own))).drop("__turn", "__last")


def runs(df: DataFrame, keys: list[str], value: str, name: str = "run") -> DataFrame:
    """Number the runs of consecutive equal ``value`` in the order of ``keys`` (unique), from 1."""
    laid = laid_out(df, *keys)
    marked = previous(laid, keys, value, "__prior").withColumn("__first", (~F.col("__prior").eqNullSafe(F.col(value)) | F.col("__prior").isNull()).cast("long"))
    return running_sum(marked, keys, F.col("__first"), name).drop("__prior", "__first", PART)
