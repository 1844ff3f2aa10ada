r"""Benchmark decontamination by latent semantic retrieval.

Benchmark items form blocks of bounded bytes, and each block is a query set against all documents. Over a block's words,
idf comes from all documents, and words that a fiftieth of them have are left out of the vectors; a randomised singular value decomposition of TF-IDF passages (distributed products with
a fixed random matrix, power iterations, a small problem on the driver) gives ``RANK`` latent directions. It is fitted
on every passage of every document, of which the words in use are written once a block, and on all items of the block. Documents are cut into windows of 8, 16, 32 ... words that overlap
by half; a window is compared by cosine with the items of its size. Candidates are then checked on the words around the
window: the longest common subsequence with the item must cover ``OVERLAP`` of it, or ``PARAPHRASE`` of it with
``OVERLAP`` of the item's answer (its last quarter, three words at least).

Words are runs of letters and digits, with A-Z lower-cased. Defined cases: null texts count as empty; items of fewer
than ``MIN_WORDS`` words and items without id name no document; items with equal texts each get their own rows; rows
that repeat an id give one row per item; an empty table on either side gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import encoded, forget, lean, pieces, slices, text_of, word_hashes, written

MIN_WORDS = 5
RANK = 64
BLOCK_BYTES = 4 << 20
COSINE = 0.45
STOP_SHARE = 0.02
#: Share of an item's words (other than very frequent ones) that a candidate window has at least.
SHARED = 0.35
OVERLAP = 0.8
PARAPHRASE = 0.6
SEED = 11
_SHORTEST = 8
#: ASCII other than letters and digits separates words; so does nothing else.
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


class Lexicon:
    """The words of a block of items, as sorted hashes."""

    def __init__(self, texts: list[bytes]):
        hashes, counts = word_hashes([t.translate(_TABLE) for t in texts])
        self._hold(np.unique(hashes))
        self.items = np.split(np.searchsorted(self.keys, hashes), np.cumsum(counts)[:-1]) if len(texts) else []

    def _hold(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(keys >> np.uint64(44)).astype(np.int64)] = True

    def only(self, used: np.ndarray) -> Lexicon:
        """Some of the words, numbered anew, and no items."""
        out = Lexicon([])
        out._hold(self.keys[used])
        return out

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's number, -1 for others."""
        out = np.full(len(hashes), -1)
        likely = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.searchsorted(self.keys, hashes[likely])
        at[at == len(self.keys)] = 0
        right = self.keys[at] == hashes[likely] if len(self.keys) else np.zeros(0, bool)
        out[likely[right]] = at[right]
        return out

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Each word's number, -1 for others; words of each text."""
        hashes, counts = word_hashes([t.translate(_TABLE) for t in texts])
        return self.numbers(hashes), counts


def document_frequencies(docs: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, int]:
    """For each word the number of documents with it, and the number of documents; over all of them."""
    size = len(lexicon.keys)

    def run(batches):
        total, n = np.zeros(size, np.int64), 0
        for batch in slices(batches):
            texts = encoded(batch.column("text").to_pylist())
            n += len(texts)
            for low, high in pieces(texts):
                words, counts = lexicon.read(texts[low:high])
                doc = np.repeat(np.arange(high - low), counts)
                seen = np.unique(doc[words >= 0] * size + words[words >= 0])
                total += np.bincount(seen % size, minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"word": pa.array(np.append(used, -1), pa.int32()), "n": pa.array(np.append(total[used], n), pa.int64())})

    out, n = np.zeros(size, np.int64), 0
    for r in docs.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():  # at most a row per word of the block
        if r["word"] < 0:
            n = r["n"]
        else:
            out[r["word"]] = r["n"]
    return out, n


def word_weights(lexicon: Lexicon, df: np.ndarray, n: int) -> np.ndarray:
    """idf, but 0 for words of more than ``STOP_SHARE`` of the documents, unless an item has fewer than three others."""
    idf = np.log((n + 1) / (df + 1)) + 1e-3
    stop = df > STOP_SHARE * n
    for x in lexicon.items:
        if len(set(x[~stop[x]].tolist())) < 3:
            stop[x] = False
    return np.where(stop, 0.0, idf)


def _passages(at: np.ndarray, counts: np.ndarray, length: int = 32) -> np.ndarray:
    """The passage of the words at the ascending places ``at``: runs of ``length`` words of a text."""
    ends, runs = np.cumsum(counts), -(-counts // length)
    doc = np.searchsorted(ends, at, side="right")
    return (np.cumsum(runs) - runs)[doc] + (at - (ends - counts)[doc]) // length


def passages(docs: DataFrame, lexicon: Lexicon, weights: np.ndarray) -> DataFrame:
    """(words, passages) of all documents: the numbers of the words with a weight and of their passages, as 32-bit
    integers; a row for each of ``pieces``, with its own count of passages."""
    used = np.flatnonzero(weights > 0)
    part = lexicon.only(used)

    def run(batches):
        for batch in slices(batches):
            texts = encoded(batch.column("text").to_pylist())
            rows = []
            for low, high in pieces(texts):
                words, counts = part.read(texts[low:high])
                known = np.flatnonzero(words >= 0)
                rows.append((used[words[known]].astype(np.int32).tobytes(), _passages(known, counts).astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_pydict({"words": pa.array([w for w, _ in rows], pa.binary()), "passages": pa.array([p for _, p in rows], pa.binary())})

    return docs.select("text").mapInArrow(run, "words binary, passages binary")


def _add_product(out: np.ndarray, words: np.ndarray, passage: np.ndarray, idf: np.ndarray, right: np.ndarray) -> None:
    """Add A' (A right) of the unit-length TF-IDF passages A to ``out``."""
    known = idf[words] > 0
    if not known.any():
        return
    cell, tf = np.unique(passage[known].astype(np.int64) * len(idf) + words[known], return_counts=True)
    row, col = cell // len(idf), cell % len(idf)
    first = np.flatnonzero(np.diff(row, prepend=-1))
    size = np.diff(np.append(first, len(row)))
    weight = tf * idf[col]
    weight = (weight / np.repeat(np.sqrt(np.add.reduceat(weight**2, first)), size))[:, None]
    left = np.repeat(np.add.reduceat(weight * right[col], first), size, axis=0) * weight
    order = np.argsort(col, kind="stable")
    col = col[order]
    first = np.flatnonzero(np.diff(col, prepend=-1))
    out[col[first]] += np.add.reduceat(left[order], first)


def latent_directions(own: DataFrame, lexicon: Lexicon, idf: np.ndarray, rank: int = RANK, rounds: int = 2) -> np.ndarray:
    """words x rank: the main right singular vectors of all ``passages`` and of the items, a passage each."""
    size = len(lexicon.keys)
    right = np.random.default_rng(SEED).standard_normal((size, min(size, rank + 8)))
    counts = np.array([len(x) for x in lexicon.items])
    items = np.concatenate(lexicon.items), np.repeat(np.arange(len(counts)), counts)

    def times(right: np.ndarray) -> np.ndarray:
        def run(batches):
            total = np.zeros_like(right)
            for batch in slices(batches):
                for words, passage in zip(batch.column("words").to_pylist(), batch.column("passages").to_pylist(), strict=True):
                    _add_product(total, np.frombuffer(words, np.int32), np.frombuffer(passage, np.int32), idf, right)
            step = 512
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(0, size, step), pa.int32()), "rows": pa.array([total[i : i + step].tobytes() for i in range(0, size, step)], pa.binary())})

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"at": rows["at"][:1], "rows": [sum(np.frombuffer(x, float) for x in rows["rows"]).tobytes()]})

        out = np.zeros_like(right)
        _add_product(out, *items, idf, right)
        for r in own.mapInArrow(run, "at int, rows binary").groupBy("at").applyInPandas(add, "at int, rows binary").collect():  # the block's words x rank
            part = np.frombuffer(r["rows"], float).reshape(-1, right.shape[1])
            out[r["at"] : r["at"] + len(part)] += part
        return out

    for _ in range(rounds):
        right, _ = np.linalg.qr(times(right))
    values, vectors = np.linalg.eigh(right.T @ times(right))
    return (right @ vectors[:, ::-1][:, :rank]).astype(np.float32)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by words of bits."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for x in b:
        if m := masks.get(x):
            u = row & m
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def is_leak(item: list[int], around: list[int], overlap: float = OVERLAP, paraphrase: float = PARAPHRASE) -> tuple[bool, float]:
    share = common_subsequence(item, around) / len(item)
    if share >= overlap or share < paraphrase:
        return share >= overlap, share
    answer = item[-max(3, len(item) // 4) :]
    return common_subsequence(answer, around) / len(answer) >= overlap, share


def window_sizes(words: int) -> set[int]:
    """The powers of two around a number of words."""
    return {max(_SHORTEST, 1 << (words - 1).bit_length()), max(_SHORTEST, 1 << words.bit_length() - 1)}


class Searcher:
    """Windows of texts against the items of a block.

    Words that more than ``STOP_SHARE`` of the documents have tell nothing about an item and are left out of the vectors
    (they count in the check), unless an item has fewer than three others.
    """

    def __init__(self, lexicon: Lexicon, ids: list[int], weights: np.ndarray, directions: np.ndarray, cosine: float = COSINE):
        self.lexicon, self.ids, self.cosine = lexicon, ids, cosine
        self.vectors = (weights[:, None] * directions).astype(np.float32)
        used = np.flatnonzero(weights > 0)
        self.rare, self.number = lexicon.only(used), used
        self.words = [set(x[weights[x] > 0].tolist()) for x in lexicon.items]
        self.by_size: dict[int, tuple[list[int], np.ndarray, int]] = {}
        for size in set().union(*(window_sizes(len(x)) for x in lexicon.items)):
            own = [i for i, x in enumerate(lexicon.items) if size in window_sizes(len(x))]
            m = np.stack([self.vectors[lexicon.items[i]].sum(axis=0) for i in own])
            self.by_size[size] = own, (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)).T, min(2, *(len(self.words[i]) for i in own))

    def candidates(self, words: np.ndarray, counts: np.ndarray):
        """(text, first word, size, item) of windows that are near an item; ``words``: numbers, -1 where not in use."""
        first = np.cumsum(counts) - counts
        known = np.flatnonzero(words >= 0)
        if not len(known):
            return
        doc = np.searchsorted(first + counts, known, side="right")
        number = words[known]
        listed = number.tolist()
        sums = np.zeros((len(known) + 1, self.vectors.shape[1]), np.float32)
        np.cumsum(self.vectors[number], axis=0, out=sums[1:])
        for size, (items, m, least) in self.by_size.items():
            turn = doc * (1 << 32) + (known - first[doc]) // (size // 2)
            windows = np.unique(np.concatenate((turn, turn[turn % (1 << 32) > 0] - 1)))
            owner, at = windows >> 32, (windows & 0xFFFFFFFF) * (size // 2)
            low, high = np.searchsorted(known, first[owner] + at), np.searchsorted(known, first[owner] + np.minimum(at + size, counts[owner]))
            full = np.flatnonzero(high - low >= least)
            for k in range(0, len(full), 8192):
                own = full[k : k + 8192]
                v = sums[high[own]] - sums[low[own]]
                near = v @ m >= self.cosine * np.maximum(np.linalg.norm(v, axis=1), 1e-6)[:, None]
                for w, i in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
                    j, item = own[w], items[i]
                    if len(self.words[item].intersection(listed[low[j] : high[j]])) >= SHARED * len(self.words[item]):
                        yield owner[j], at[j], size, item

    def __call__(self, texts: list[bytes]):
        """(text, item, share) of all leaks."""
        hashes, counts = word_hashes([t.translate(_TABLE) for t in texts])
        words = self.rare.numbers(hashes)
        words[words >= 0] = self.number[words[words >= 0]]
        first = np.cumsum(counts) - counts
        found: dict[tuple[int, int], float] = {}
        for d, at, size, i in self.candidates(words, counts):
            low, high = first[d] + max(0, at - size), first[d] + min(counts[d], at + 2 * size)
            leak, share = is_leak(self.lexicon.items[i].tolist(), self.lexicon.numbers(hashes[low:high]).tolist())
            if leak:
                found[d, i] = max(share, found.get((d, i), 0))
        return [(d, self.ids[i], s) for (d, i), s in found.items()]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, item id, overlap) of every document that holds a benchmark item; overlap: the item's share in the
    common subsequence."""
    lean(docs.sparkSession)
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item"), text_of(item_text_col).alias("text"))
    blocks = max(1, -(-int(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    found = None
    for b in range(blocks):
        own = [(r["item"], r["text"].encode()) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()]  # about block_bytes
        lexicon = Lexicon([t for _, t in own])
        long_enough = [k for k, x in enumerate(lexicon.items) if len(x) >= MIN_WORDS]
        if not long_enough:
            continue
        ids, lexicon.items = [own[k][0] for k in long_enough], [lexicon.items[k] for k in long_enough]
        df, n = document_frequencies(texts, lexicon)
        weights = word_weights(lexicon, df, n)
        fitted = written(passages(texts, lexicon, weights), "passages")  # one scan; only the words in use
        searcher = Searcher(lexicon, ids, weights, latent_directions(fitted, lexicon, weights))
        forget(fitted)

        def run(batches, searcher=searcher):
            for batch in slices(batches):
                doc, whole = batch.column("id").to_pylist(), encoded(batch.column("text").to_pylist())
                rows = [(doc[low + d], i, s) for low, high in pieces(whole) for d, i, s in searcher(whole[low:high])]
                yield pa.RecordBatch.from_pydict(dict(zip(("id", "item", "overlap"), (pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))), strict=True)))

        part = texts.mapInArrow(run, "id long, item long, overlap double")
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "id long, item long, overlap double")
    return found.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col)).agg(F.max("overlap").alias("overlap"))
