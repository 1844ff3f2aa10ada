"""Exact dedup over a minimal perfect hash of historical digests.

A history of documents becomes an index of bounded buckets. A bucket holds a minimal perfect hash (hash and displace)
whose slots keep the full 32-byte digest and the winner's id. New documents are reduced to distinct digests, probe
their bucket, and count as repeats only if all bytes of the slot's digest agree; digests that the history lacks group
among themselves. Buckets hold a bounded number of distinct digests however often a text repeats.

Defined cases: a null text counts as empty; empty texts are equal to each other; a null id never wins against an
existing one; rows that repeat id and text are marked alike; an empty table gives no rows; columns other than the id
and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import WS, lean, met_by_key, mix, text_of, written

BUCKET_DIGESTS = 4096
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Stands for a null id in an index.
_NO_ID = -1 << 63
#: Buckets in a task.
TASK_BUCKETS = 8
_INDEX = "bucket int, n int, seeds binary, digests binary, winners binary, counts binary"
_FOUND = "digest binary, keep_id long, group_size long, in_history boolean"


def _parts(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = digests.view("<u8").reshape(-1, 4)
    return words[:, 1].copy(), words[:, 2].copy()


def _slots(seeds: np.ndarray, digests: np.ndarray, n: int) -> np.ndarray:
    key, small = _parts(digests)
    seed = seeds[(small % np.uint64(len(seeds))).astype(np.int64)].astype(np.int64)
    hashed = (mix(key + seed.astype(np.uint64) * _STEP) % np.uint64(n)).astype(np.int64)
    return np.where(seed < 0, -seed - 1, hashed)


def minimal_perfect_hash(digests: np.ndarray) -> np.ndarray:
    """Seeds that send each of the distinct ``digests`` (n x 32 bytes) to a slot of its own in 0 .. n - 1.

    Small buckets, the largest first, try blocks of seeds until their keys meet free slots; a bucket of one key names its
    slot outright.
    """
    n = len(digests)
    key, small = _parts(digests)
    m = n // 4 + 1
    small = (small % np.uint64(m)).astype(np.int64)
    order, sizes = np.argsort(small, kind="stable"), np.bincount(small, minlength=m)
    ends = np.cumsum(sizes)
    seeds, taken = np.zeros(m, np.int32), np.zeros(n, bool)
    many = np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())]
    for b in many.tolist():
        keys, first, tries = key[order[ends[b] - sizes[b] : ends[b]]], 0, 4
        while True:
            trial = np.arange(first, first + tries, dtype=np.uint64)
            at = (mix(keys + (trial * _STEP)[:, None]) % np.uint64(n)).astype(np.int64)
            free = np.flatnonzero(~taken[at].any(axis=1))
            good = next((i for i in free.tolist() if len(set(at[i].tolist())) == len(keys)), None)
            if good is not None:
                break
            first, tries = first + tries, min(2 * tries, 1024)
        seeds[b] = first + good
        taken[at[good]] = True
    for b, slot in zip(np.flatnonzero(sizes == 1).tolist(), np.flatnonzero(~taken).tolist(), strict=False):
        seeds[b] = -slot - 1
    return seeds


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def _build(bucket: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(rows["digest"])
    seeds = minimal_perfect_hash(digests)
    slot, n = _slots(seeds, digests, len(digests)), len(digests)
    own, winners, counts = np.empty_like(digests), np.empty(n, np.int64), np.empty(n, np.int64)
    own[slot], winners[slot], counts[slot] = digests, rows["id"], rows["n"]
    return pd.DataFrame({"bucket": [bucket[0]], "n": [n], "seeds": [seeds.tobytes()], "digests": [own.tobytes()], "winners": [winners.tobytes()], "counts": [counts.tobytes()]})


def _probe(_: tuple, new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(new["digest"])
    winner, total = new["id"].to_numpy(np.int64, copy=True), new["n"].to_numpy(np.int64, copy=True)
    member = np.zeros(len(new), bool)
    parts = [pd.DataFrame({"digest": [], "keep_id": [], "group_size": [], "in_history": []})]
    if len(index):
        (n, seeds, own, winners, counts) = index.iloc[0][["n", "seeds", "digests", "winners", "counts"]]
        own, winners, counts = np.frombuffer(own, np.uint8).reshape(n, 32), np.frombuffer(winners, np.int64), np.frombuffer(counts, np.int64)
        alone = np.ones(n, bool)
        if len(new):
            slot = _slots(np.frombuffer(seeds, np.int32), digests, n)
            member = (own[slot] == digests).all(axis=1)
            known, mine = winners[slot[member]], winner[member]
            winner[member] = np.where(mine == _NO_ID, known, np.where(known == _NO_ID, mine, np.minimum(mine, known)))
            total[member] += counts[slot[member]]
            alone[slot[member]] = False
        rest = np.flatnonzero(alone)
        parts.append(pd.DataFrame({"digest": [own[i].tobytes() for i in rest], "keep_id": winners[rest], "group_size": counts[rest], "in_history": True}))
    parts.append(pd.DataFrame({"digest": list(new["digest"]), "keep_id": winner, "group_size": total, "in_history": member}))
    return pd.concat([p for p in parts if len(p)] or parts[:1])


def with_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest) of the normalised whole texts."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(F.regexp_replace(text_of(text_col), WS, " "), 256)).alias("digest"))


def _distinct(digests: DataFrame, buckets: int) -> DataFrame:
    """One row per digest, aggregated before the shuffle, with its bucket."""
    one = digests.groupBy("digest").agg(F.coalesce(F.min("id"), F.lit(_NO_ID)).alias("id"), F.count(F.lit(1)).alias("n"))
    return one.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Buckets over as many tasks as they need, however few bytes they hold: each costs time, not space."""
    return rows.repartition(max(1, -(-buckets // TASK_BUCKETS)), "bucket")


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The index of a history of (id, digest) rows, written to the shared folder."""
    return written(_dealt(_distinct(history, buckets), buckets).groupBy("bucket").applyInPandas(_build, _INDEX), "digest-index")


def probe_index(index: DataFrame, incoming: DataFrame, buckets: int) -> DataFrame:
    """For each digest of history and ``incoming`` (id, digest): keep_id, group_size and whether the history has it."""
    found = _dealt(_distinct(incoming, buckets), buckets).groupBy("bucket").cogroup(_dealt(index, buckets).groupBy("bucket")).applyInPandas(_probe, _FOUND)
    return found.withColumn("keep_id", F.nullif("keep_id", F.lit(_NO_ID)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", history_until: int | None = None) -> DataFrame:
    """Per document: its id, keep_id, group_size, kept, text_sha256.

    Documents with ids up to ``history_until`` (the middle of the ids if not given) are the history, the others arrive
    later; which is which doesn't change the result.
    """
    lean(docs.sparkSession)
    digests = written(with_digests(docs, id_col, text_col), "digests")
    low, high, n = digests.agg(F.min("id"), F.max("id"), F.count(F.lit(1))).first()
    buckets = max(1, -(-n // BUCKET_DIGESTS))
    middle = history_until if history_until is not None else (low + high) // 2 if low is not None else 0
    old = F.coalesce(F.col("id") <= middle, F.lit(False))
    index = build_index(digests.where(old), buckets)
    found = written(probe_index(index, digests.where(~old), buckets), "digest-winners")
    met = met_by_key(digests, found.withColumn("copies", F.col("group_size")), ["digest"], "copies", n)
    return met.select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "in_history"
    )
