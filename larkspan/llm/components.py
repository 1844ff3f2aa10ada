"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import forget, met_by_key, written


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """(src, dst) with dst <= src. Large star: larger neighbours go to the smallest one; small star: the others.

    ``total``: rows of ``edges``. A node of very many neighbours is met by broadcast, so its edges stay spread.
    """
    both = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).union(edges.select(F.col("dst").alias("u"), F.col("src").alias("v")))
    if not large:
        both = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("degree"))
    moved = met_by_key(both, least, ["u"], "degree", total * (2 if large else 1))
    least = least.drop("degree")
    if large:
        out = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("src"), F.col("m").alias("dst"))
    else:
        out = moved.select(F.col("v").alias("src"), F.col("m").alias("dst")).union(least.select(F.col("u").alias("src"), F.col("m").alias("dst")))
    return out.where(F.col("src") != F.col("dst")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge (src, dst); the component is its smallest node. No edges, no rows."""
    now = written(edges.where(F.col("src") != F.col("dst")).select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges")
    rows = now.count()
    while True:
        large = written(_star(now, True, rows), "edges")
        then = written(_star(large, False, large.count()), "edges")
        forget(large)
        before, rows = rows, then.count()
        same = rows == before and then.join(now, ["src", "dst"], "left_anti").isEmpty()
        forget(now)
        now = then
        if same:
            break
    tops = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(tops)
