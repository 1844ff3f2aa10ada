"""What several operators share: the shared folder, written tables, words and hashes of whole texts."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.storage import shared_dir

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WS = r"[\x20\x09-\x0D]+"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/larkspan/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._larkspan_path = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete tables made by ``written`` that no later step reads, and let Spark drop their shuffle files."""
    for df in frames:
        spark = df.sparkSession
        jvm, path = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(df._larkspan_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        jvm.System.gc()


def settle(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now."""
    spark._jvm.System.gc()


#: Keys that at least one row in so many has are hot: there are no more than so many of them.
HOT_KEYS = 100_000


def met_by_key(rows: DataFrame, by_key: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """Join (inner or left) of ``rows`` with ``by_key``, a row for each key with the number (``weight``) of ``rows`` that have it.

    ``total``: the sum of the weights. Hot keys, those of one row in ``HOT_KEYS`` or more, are broadcast (``HOT_KEYS`` rows
    at most) and their rows stay where they are; the others are shuffled, no key of them with more than a ``HOT_KEYS``-th of all rows.
    """
    is_hot = F.col(weight) * HOT_KEYS >= F.lit(total)
    if total <= HOT_KEYS:  # all are
        return rows.join(F.broadcast(by_key.drop(weight)), keys, how)
    rest = rows.join(F.broadcast(by_key.where(is_hot).select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(by_key.where(is_hot).drop(weight)), keys).unionByName(rest.join(by_key.where(~is_hot).drop(weight), keys, how))


def text_of(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def without_spans(lines: Column, lows: Column, highs: Column) -> Column:
    """The array ``lines``, a column of its own, without its spans [low, high), ascending and apart; in linear time."""
    low, high = F.concat(F.array(F.lit(0)), highs), F.concat(lows, F.array(F.size(lines)))
    return F.flatten(F.transform(F.arrays_zip(low.alias("low"), high.alias("high")), lambda z: F.slice(lines, z["low"] + 1, z["high"] - z["low"])))


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: sizes the number of partitions, never which rows are used."""
    return int(df.agg(F.sum(F.octet_length(text_of(column)))).first()[0] or 0)


# ---------------------------------------------------------------------------------------------------------------
# Vectorised hashing of words in a batch of texts (numpy, no Python object for each word).

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64, kept between calls."""
    have = _POWERS.get(int(base))
    if have is None or len(have) <= n:
        have = _POWERS[int(base)] = _powers(base, max(n, 1 << 19))
    return have


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of byte hashes times BASE ** position, over data[i:j]."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE[data] * powers(_BASE, len(data))[: len(data)], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], independent of where the bytes stand; ranges may overlap.

    A power series modulo 2 ** 64 cannot tell certain self-similar strings of 1024 bytes and more apart (a Thue-Morse word
    and its complement), so it is for ranges well below that; ``span_hashes`` takes words of any length.
    """
    inverse = powers(_INVERSE, len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def _weights(low: int, high: int) -> np.ndarray:
    """Odd pseudo-random weights of the places low .. high - 1 in a word."""
    return mix(np.arange(low + 1, high + 1, dtype=np.uint64) * _BASE) | np.uint64(1)


_FIRST_WEIGHTS = _weights(0, 1 << 12)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] of spans that follow each other and are not empty: multilinear, each place of a span
    with its own weight, so no structure of a long word cancels out."""
    if not len(start):
        return np.empty(0, np.uint64)
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    weight = _FIRST_WEIGHTS[place] if size.max() <= len(_FIRST_WEIGHTS) else _weights(0, int(size.max()))[place]
    return mix(np.add.reduceat(_BYTE[data[place + np.repeat(start, size)]] * weight, first) + size.astype(np.uint64))


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of all texts, one after the other: the bytes they stand in, starts and ends; each text's words."""
    if not texts:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint8), none, none, none
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[joined])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    return joined, start, end, np.diff(np.concatenate(([0], np.searchsorted(start, ends))))


def lower_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the lower-cased (A-Z) bytes of each range."""
    return span_hashes(_LOWER[data], start, end)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, one after the other, and each text's number of words."""
    data, start, end, counts = word_spans(texts)
    return lower_hashes(data, start, end), counts


def shingle_sets(texts: list[bytes], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed ``k``-word shingles of each text, ascending in a text, and each text's number of them.

    A text of fewer than ``k`` words is one shingle; one without words has none.
    """
    words, counts = word_hashes(texts)
    if not len(words):
        return words, counts
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    n = len(words)
    weights = [mix(np.uint64(i + 1) * _BASE + np.zeros(1, np.uint64))[0] | np.uint64(1) for i in range(k)]
    whole = np.zeros(n, np.uint64)
    for i in range(min(k, n)):
        whole[: n - i] += words[i:] * weights[i]
    doc = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(n) - first[doc]
    keep = at <= counts[doc] - k
    short = np.flatnonzero((counts > 0) & (counts < k))
    shingle, owner = mix(whole[keep]), doc[keep]
    if len(short):
        extra = np.array([sum((words[first[d] + i] * weights[i] for i in range(counts[d])), np.uint64(0)) for d in short], np.uint64)
        shingle, owner = np.concatenate((shingle, mix(extra + counts[short].astype(np.uint64)))), np.concatenate((owner, short))
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    fresh = np.ones(len(shingle), bool)
    fresh[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    shingle, owner = shingle[fresh], owner[fresh]
    return shingle, np.bincount(owner, minlength=len(texts))


def encoded(values: list) -> list[bytes]:
    """Texts as UTF-8; null counts as empty."""
    return [b"" if v is None else v.encode("utf-8", "surrogatepass") for v in values]


np.seterr(over="ignore")


def pieces(texts: list[bytes], limit: int = 1 << 20):
    """(from, to) ranges of whole texts of about ``limit`` bytes, so that a batch needs bounded memory."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield start, i
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def lean(spark: SparkSession) -> None:
    """Smaller Arrow batches between Spark and its Python workers: texts are long, and a batch is held on both sides."""
    if spark.conf.get(_BATCH, "67108864b") in ("67108864b", "67108864", "64m", "64MB"):  # the default
        spark.conf.set(_BATCH, "4m")


def trim() -> None:
    """Give freed memory back to the system: a reused worker keeps what the C library and Arrow hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches, rows: int = 1024):
    """Arrow batches in slices of bounded numbers of rows; memory goes back at the end of a task."""
    try:
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                yield batch.slice(low, rows)
    finally:
        trim()
