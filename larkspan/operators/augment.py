"""Plans of augmented variants, and which tars are complete."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.functions.scalars import stem, variant_name
from larkspan.sinks.tables import assert_all_found


def plan(files: DataFrame, choices: dict[str, list[str]], variants: int = 3, seed: str = "42") -> DataFrame:
    """``variants`` rows for each file, each with a repeatable choice from every list."""
    each = files.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))))
    out = each.withColumn("name", variant_name(stem(F.col("path")), F.col("variant")))
    for kind, values in choices.items():
        hashed = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.lit(kind), "path", F.col("variant").cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")
        out = out.withColumn(kind, F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(hashed, F.lit(len(values))) + 1).cast("int")))
    return out


def checked_rirs(rirs: DataFrame, delays: DataFrame) -> DataFrame:
    """Room responses with their delays; one without a delay is an error."""
    return assert_all_found(rirs, delays, ["name"], "delay").join(delays, "name")


def completeness(events: DataFrame, variants: int = 3) -> DataFrame:
    """(tar, files, done, complete) of tar, tar_file and file_done events."""
    n = lambda t: F.count_if(F.col("type") == t)
    own = events.groupBy("tar").agg(n("tar_file").alias("files"), n("file_done").alias("done"))
    return own.withColumn("complete", (F.col("files") > 0) & (F.col("done") == variants * F.col("files")))
