"""Votes and decisions per speaker or cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gender_vote(votes: DataFrame, group: list[str], gender: str) -> DataFrame:
    """m or f, whichever has strictly more votes than the other and than '-' votes; else '-'."""
    n = {g: F.count_if(F.col(gender) == g) for g in ("m", "f", "-")}
    counted = votes.groupBy(*group).agg(*[n[g].alias(f"__{k}") for g, k in (("m", "m"), ("f", "f"), ("-", "u"))])
    m, f, u = (F.col(f"__{k}") for k in "mfu")
    return counted.select(*group, F.when((m > f) & (m > u), "m").when((f > m) & (f > u), "f").otherwise("-").alias("gender"))


def language_decision(found: Column, own: str = "lt", unknown: str = "unk", least_own: int = 3, sure: float = 0.6) -> Column:
    """Language of an array of (lang, conf): none: unknown; several others: the surest of them, the first of equals, and ''
    unless one is over 0; one other: the own language only if it came more than ``least_own`` times and the other's
    confidence is under ``sure``; no other: the own language."""
    others = F.filter(found, lambda x: x["lang"] != own)
    count = F.size(F.filter(found, lambda x: x["lang"] == own))
    start = F.struct(F.lit("").alias("lang"), F.lit(0.0).alias("conf"))
    best = F.aggregate(others, start, lambda s, x: F.when(x["conf"] > s["conf"], F.struct(x["lang"].alias("lang"), x["conf"].cast("double").alias("conf"))).otherwise(s))["lang"]
    one = F.when((count > least_own) & (F.element_at(others, 1)["conf"] < sure), F.lit(own)).otherwise(best)
    return F.when(F.size(found) == 0, F.lit(unknown)).when(F.size(others) > 1, best).when(F.size(others) == 1, one).otherwise(F.lit(own))


def first_label(members: DataFrame, labels: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, label): the label of a cluster's first labelled member."""
    return members.join(labels, ["f", "sp"]).groupBy(cluster).agg(F.min_by("label", "pos").alias("label"))


def disagreement(predictions: DataFrame, cluster: str = "cluster", label: str = "g") -> DataFrame:
    """Clusters whose members were predicted differently."""
    return predictions.groupBy(cluster).agg(F.count_distinct(label).alias("labels"), F.count(F.lit(1)).alias("members")).withColumn("mixed", F.col("labels") > 1)


def to_review(labelled: DataFrame, predicted: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Clusters whose prediction isn't their label."""
    return labelled.join(predicted, cluster).where(~F.col("label").eqNullSafe(F.col("g")))
