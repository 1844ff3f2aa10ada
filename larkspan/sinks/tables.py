"""Keyed writes on plain Parquet: each returns the table's new state, to be written as a new version or partition.

Where new rows repeat a key, they count as writes one after the other, in the order of ``order`` (columns of the new rows; rows
equal in it by a hash of their values): the last one stands, for an insert that keeps what is there the first one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _turn(new: DataFrame, keys: list[str], order: Sequence[str]) -> Column:
    rest = [c for c in new.columns if c not in keys]
    return F.struct(*order, (F.xxhash64(*rest) if rest else F.lit(0)).alias("__hash"))


def _one_each(new: DataFrame, keys: list[str], order: Sequence[str], first: Sequence[str] = ()) -> DataFrame:
    """The last row of each key, but the first row's values of the columns ``first``."""
    turn, rest = _turn(new, keys, order), [c for c in new.columns if c not in keys]
    last = [c for c in rest if c not in first]
    picked = [f(F.struct(*own), turn).alias(name) for f, own, name in ((F.max_by, last, "__last"), (F.min_by, [c for c in rest if c in first], "__first")) if own]
    if not picked:
        return new.select(*keys).distinct()
    return new.groupBy(*keys).agg(*picked).select(*keys, *[F.col(f"__{'first' if c in first else 'last'}.{c}").alias(c) for c in rest])


def _last_values(new: DataFrame, keys: list[str], columns: list[str], order: Sequence[str]) -> DataFrame:
    """Per key the last value of each column that is not null, as __<column>."""
    turn = _turn(new, keys, order)
    return new.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), turn)).alias(f"__{c}") for c in columns])


def insert_if_absent(target: DataFrame, new: DataFrame, keys: list[str], order: Sequence[str] = ()) -> DataFrame:
    """``target`` and those rows of ``new`` whose keys it lacks; of new rows with one key, the first."""
    fresh = _one_each(new, keys, order, new.columns).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def insert_strict(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` and ``new``; fails when evaluated if a key comes twice."""
    both = target.unionByName(new, allowMissingColumns=True)
    again = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    checked = again.withColumn("__ok", F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("repeated key "), F.to_json(F.struct(*keys))))).otherwise(F.lit(True)).cast("boolean"))
    return both.join(checked.where("__ok").select(*keys), keys, "left_semi")


def upsert(target: DataFrame, new: DataFrame, keys: list[str], keep: list[str] = ("created_at",), order: Sequence[str] = ()) -> DataFrame:
    """New rows replace old ones by key; columns of ``keep`` stay those of the old row, or of the first new one."""
    new = _one_each(new, keys, order, keep)
    columns = [c for c in target.columns if c not in keys]
    n = new.select(*keys, F.lit(True).alias("__new"), *[F.col(c).alias(f"__{c}") for c in columns if c in new.columns])
    o = target.withColumn("__old", F.lit(True))

    def value(c: str):
        if c not in new.columns:
            return F.col(c)
        first, second = (f"{c}", f"__{c}") if c in keep else (f"__{c}", f"{c}")
        mark = "__old" if c in keep else "__new"
        return F.when(F.col(mark), F.col(first)).otherwise(F.col(second)).alias(c)

    return o.join(n, keys, "full").select(*keys, *[value(c) for c in columns])


def merge_columns(target: DataFrame, new: DataFrame, keys: list[str], columns: list[str], order: Sequence[str] = ()) -> DataFrame:
    """Insert missing keys and set only ``columns``; null news and all other columns leave the old values."""
    n = _last_values(new, keys, columns, order)
    rest = [c for c in target.columns if c not in keys]
    return target.join(n, keys, "full").select(*keys, *[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in rest])


def update_columns(target: DataFrame, new: DataFrame, keys: list[str], columns: list[str], order: Sequence[str] = ()) -> DataFrame:
    """Set ``columns`` where ``new`` has the key; never inserts."""
    n = _last_values(new, keys, columns, order)
    return target.join(n, keys, "left").select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in target.columns])


def move_source(files: DataFrame, ids: DataFrame, source: str) -> DataFrame:
    """Give the files of ``ids`` another source."""
    return update_columns(files, ids.select("id").distinct().withColumn("source", F.lit(source)), ["id"], ["source"])


def set_speaker_durations(file_speakers: DataFrame, new: DataFrame) -> DataFrame:
    return merge_columns(file_speakers, new, ["file_id", "speaker"], ["duration_in_sec", "segments"])


def set_language(file_speakers: DataFrame, new: DataFrame) -> DataFrame:
    return merge_columns(file_speakers, new, ["file_id", "speaker"], ["language"])


def apply_clusters(file_speakers: DataFrame, members: DataFrame) -> DataFrame:
    """``members``: (global_speaker, f, sp); only speakers that exist are named."""
    named = members.select(F.col("f").alias("file_id"), F.col("sp").alias("speaker"), "global_speaker").dropDuplicates(["file_id", "speaker"])
    return update_columns(file_speakers, named, ["file_id", "speaker"], ["global_speaker"])


def apply_genders(file_speakers: DataFrame, genders: DataFrame) -> DataFrame:
    return update_columns(file_speakers, genders, ["file_id", "speaker"], ["gender"])


def snapshot(tables: dict[str, DataFrame], folder: str) -> None:
    """Copy tables to a folder; ``restore`` reads them."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def restore(spark, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def assert_all_found(wanted: DataFrame, known: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``wanted``, or an error on evaluation if ``known`` lacks one of its keys."""
    marked = wanted.join(known.select(*keys).distinct().withColumn("__known", F.lit(True)), keys, "left")
    message = F.concat(F.lit(f"no {what} for "), F.to_json(F.struct(*keys)))
    return marked.where(F.when(F.col("__known"), True).otherwise(F.raise_error(message).cast("boolean"))).drop("__known")


def union_shards(shards: list[DataFrame], order: str) -> DataFrame:
    """Lines of shards one after the other: (rank, order, ...)."""
    ranked = [df.withColumn("rank", F.lit(i)) for i, df in enumerate(shards)]
    return reduce(DataFrame.unionByName, ranked).orderBy("rank", order)
