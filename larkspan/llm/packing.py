r"""Mixture-controlled packing of token ids into fixed sequences.

Each source is a queue of tokens in a fixed order (written part, then row). A window of ``window_sequences`` sequences
takes from every queue its share of the target proportions: token ``j`` of source ``s`` is due at virtual time
``(j + 1/2) / weight(s)``, and windows cut the tokens of all queues, in order of that time, into equal amounts. This is
deficit round-robin in closed form: what a source is owed after a window (its weight times the time, less what it has
been served) stays within one token and is carried into the next one, whichever partition works on it; an exhausted
queue leaves its share to the others. So no task waits for another: each piece's place follows from its token numbers,
the sources' totals (one number per source) and the target weights.

A queue is a source. A table of more than ``MAX_QUEUES`` sources has that many queues, each of the sources of one hash, so
that what the driver and the tasks hold of them is bounded; sources named in the targets keep queues of their own.

Within a window the sources' runs lie end to end, so texts are cut only at a window's or a sequence's end. All sequences
are full except the last, which alone is padded: to ``length``, unless its length is a power of two.

Defined cases: a null text counts as empty and gives the end token alone; a null source is the source ''; repeated ids
are separate documents, and so are rows without an id, which they keep; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspan.llm.common import encoded, lean, lower_hashes, pieces, slices, text_of, word_spans, written

END_TOKEN = 2
LENGTH = 4096
#: Sequences in a window that has the target proportions.
WINDOW_SEQUENCES = 64
#: Distinct words whose ids a worker remembers.
MEMO_WORDS = 1_000_000
MAX_QUEUES = 4096

_ENCODERS: dict[str, Encoder] = {}


_PLAIN = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_LETTER = np.array([c < 128 and chr(c).isalnum() for c in range(256)])


def without_tails(data: np.ndarray, start: np.ndarray, end: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of which a tail of ASCII marks stands alone, where it is a pre-token of its own: behind an ASCII letter or
    digit, or a letter of U+00C0 to U+00FF."""
    if not len(start):
        return start, end, counts
    core = np.maximum.accumulate(np.where(_PLAIN[data], -1, np.arange(len(data))))[end - 1] + 1
    last, before = data[core - 1], data[np.maximum(core - 2, 0)]
    cut = (core < end) & (core > start) & (_LETTER[last] | (before == 0xC3) & (last >= 128) & (last != 0x97) & (last != 0xB7))
    extra = cut.astype(np.int64)
    at = np.arange(len(start)) + np.cumsum(extra) - extra
    starts, ends = np.empty(len(start) + extra.sum(), np.int64), np.empty(len(start) + extra.sum(), np.int64)
    starts[at], ends[at] = start, np.where(cut, core, end)
    starts[at[cut] + 1], ends[at[cut] + 1] = core[cut], end[cut]
    owner = np.repeat(np.arange(len(counts)), counts)
    return starts, ends, counts + np.bincount(owner[cut], minlength=len(counts))


class Encoder:
    """Ids by the tokenizer's file, looked up for words that a worker has met before.

    The tokenizer drops white space, folds case and encodes each pre-token on its own, and no pre-token holds white
    space; so a text's ids are those of its words between white space, end to end. Texts with a special token's mark
    take the tokenizer's own way. Words are known by 64-bit multilinear hashes of their bytes, in sorted arrays of about 20 bytes a
    word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.place, self.size, self.ids = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def _all(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Ids of new words, from one text of some thousands of them and the places its tokens have there."""
        sizes, found = [], []
        for low in range(0, len(words), 4096):
            own = words[low : low + 4096]
            made = self.tokenizer.encode(" ".join(own), add_special_tokens=False)
            found.append(np.array(made.ids, np.uint32))
            ends = np.cumsum([len(w) + 1 for w in own])
            sizes.append(np.diff(np.searchsorted(np.array([a for a, _ in made.offsets], np.int64), ends), prepend=0))
        size = np.concatenate(sizes)
        at = np.searchsorted(self.keys, keys)
        self.place = np.insert(self.place, at, len(self.ids) + np.cumsum(size) - size)
        self.keys, self.size, self.ids = np.insert(self.keys, at, keys), np.insert(self.size, at, size), np.concatenate([self.ids, *found])

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        data, start, end, counts = word_spans(texts)
        start, end, counts = without_tails(data, start, end, counts)
        distinct, first, which = np.unique(lower_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.keys) > MEMO_WORDS:
            self._forget()
        new = np.flatnonzero(self._unknown(distinct))
        if len(new):
            raw = data.tobytes()
            self._learn(distinct[new], [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
        at = np.searchsorted(self.keys, distinct)[which]
        size = self.size[at] if len(at) else at
        done = np.cumsum(size)
        ids = self.ids[np.repeat(self.place[at] - (done - size), size) + np.arange(done[-1])] if len(at) else self.ids[:0]
        return np.split(ids, np.concatenate(([0], done))[np.cumsum(counts)[:-1]])

    def _unknown(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] != keys

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        plain = [i for i, t in enumerate(texts) if "<|" not in t]
        odd = [i for i, t in enumerate(texts) if "<|" in t]
        own, found = encoded([texts[i] for i in plain]), {}
        for low, high in pieces(own):
            found.update(zip(plain[low:high], self._plain(own[low:high]), strict=True))
        found.update(zip(odd, self._all([texts[i] for i in odd]), strict=True))
        return [found[i] for i in range(len(texts))]


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Mixture:
    """Places of tokens. ``totals``: tokens of each source; ``weights``: target proportions, of any scale."""

    def __init__(self, totals: list[int], weights: list[float], window: int):
        self.totals, self.window = np.array(totals, np.int64), window
        w = np.array(weights, float)
        self.weights = np.maximum(w / w.sum(), 1e-12)
        self.all = int(self.totals.sum())
        self.known: dict[int, np.ndarray] = {}

    def _due(self, times: np.ndarray) -> np.ndarray:
        """Tokens of each source that are due at each of ``times``."""
        return np.minimum(np.floor(times[:, None] * self.weights[None, :] + 0.5), self.totals[None, :]).astype(np.int64)

    def served(self, windows: np.ndarray) -> np.ndarray:
        """Tokens of each source in the first ``windows`` windows; each row sums to the tokens of those windows."""
        need = np.minimum(windows.astype(np.int64) * self.window, self.all)
        low, high = np.zeros(len(need)), np.full(len(need), float(((self.totals + 1) / self.weights).max()))
        for _ in range(110):
            middle = (low + high) / 2
            enough = self._due(middle).sum(axis=1) >= need
            low, high = np.where(enough, low, middle), np.where(enough, middle, high)
        base, top = self._due(low), self._due(high)
        base[need == 0] = 0
        short = need - base.sum(axis=1)
        for s in range(len(self.totals)):  # tokens due at the same time: the first sources go first
            more = np.minimum(short, top[:, s] - base[:, s]).clip(min=0)
            base[:, s] += more
            short -= more
        return base

    def at(self, window: int) -> np.ndarray:
        if window not in self.known:
            if len(self.known) > max(256, (1 << 22) // len(self.totals)):
                self.known.clear()
            block = np.arange(max(0, window - 32), window + 96)
            self.known.update(zip(block.tolist(), self.served(block), strict=True))
        return self.known[window]

    def window_of(self, source: int, token: int) -> int:
        """The window of a source's token: its rank among all tokens by time, put right where times are equal."""
        time = np.array([(token + 0.5) / self.weights[source]])
        t = int(self._due(time).sum()) // self.window
        while self.at(t)[source] > token:
            t -= 1
        while self.at(t + 1)[source] <= token:
            t += 1
        return t

    def pieces(self, source: int, first: int, n: int, length: int):
        """(start, length, sequence, offset) of a document that has tokens first .. first + n - 1 of its source."""
        t, done = self.window_of(source, first), 0
        while done < n:
            before, after = self.at(t), self.at(t + 1)
            run = min(n - done, int(after[source]) - first - done)
            place = t * self.window + int((after - before)[:source].sum()) + first + done - int(before[source])
            while run > 0:
                size = min(run, length - place % length)
                yield done, size, place // length, place % length
                done, run, place = done + size, run - size, place + size
            t += 1


def tokenised(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Written table of (id, source, part, first, n, ids): ids of 16 bits where they fit, else 32, with the end token;
    ``first`` counts the tokens of the same source before the row in its part."""
    lean(docs.sparkSession)

    def run(batches):
        part, seen, encode = TaskContext.get().partitionId(), {}, encoder(tokenizer)
        for batch in slices(batches):
            source = batch.column("source").to_pylist()
            ids = [np.append(x, np.uint32(END_TOKEN)) for x in encode(batch.column("text").to_pylist())]
            first = []
            for s, x in zip(source, ids, strict=True):
                first.append(seen.get(s, 0))
                seen[s] = first[-1] + len(x)
            packed = [(x.astype("<u2") if x.max() < 1 << 16 else x.astype("<u4")).tobytes() for x in ids]
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "source": source, "part": pa.array([part] * len(ids), pa.int32()), "first": pa.array(first, pa.int64()), "n": pa.array(map(len, ids), pa.int64()), "ids": pa.array(packed, pa.binary())}
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), text_of(text_col).alias("text"))
    return written(rows.mapInArrow(run, "id long, source string, part int, first long, n long, ids binary"), "token-ids")


_PIECES = "id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(tokens: DataFrame, targets: dict[str, float] | None = None, length: int = LENGTH, window_sequences: int = WINDOW_SEQUENCES, with_ids: bool = True, max_queues: int = MAX_QUEUES) -> DataFrame:
    """Pieces of ``tokenised`` documents: id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset, and,
    if ``with_ids``, ids (32 bits each).

    ``targets``: proportion of each source; those of the corpus itself where not given.
    """
    spark, schema = tokens.sparkSession, _PIECES + ", ids binary" * with_ids
    parts = written(tokens.groupBy("source", "part").agg(F.sum("n").alias("part_n")), "token-parts")
    queue = F.col("source")
    if parts.select("source").distinct().count() > max_queues:
        queue = F.when(F.col("source").isin(list(targets or ())), F.concat(F.lit("="), "source")).otherwise(F.concat(F.lit("#"), F.pmod(F.xxhash64("source"), F.lit(max_queues)).cast("string")))
        targets = {f"={s}": w for s, w in targets.items()} if targets is not None else None
    order = Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("queue", queue)
    totals = sorted((r["queue"], r["n"]) for r in parts.groupBy("queue").agg(F.sum("part_n").alias("n")).collect())  # at most max_queues and those of targets
    parts = parts.withColumn("base", F.coalesce(F.sum("part_n").over(order), F.lit(0)))
    if not totals:
        return spark.createDataFrame([], schema)
    names = {s: i for i, (s, _) in enumerate(totals)}
    numbers = [n for _, n in totals]
    weights = numbers if targets is None else [max(0.0, targets.get(s, 0.0)) or 1e-9 for s, _ in totals]
    window = length * window_sequences

    columns = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches):
        mixture = Mixture(numbers, weights, window)
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                ids = np.frombuffer(r.ids, "<u2" if len(r.ids) < 4 * r.n else "<u4").astype("<u4")
                for start, size, sequence, offset in mixture.pieces(names[r.queue], r.base + r.first, r.n, length):
                    own = ids[start : start + size].tobytes()
                    out.append((r.id, r.source, start, size, zlib.crc32(own), r.n, sequence, offset) + (own,) * with_ids)
            yield pd.DataFrame(out, columns=columns)

    placed = tokens.join(parts.select("source", "part", "queue", "base"), ["source", "part"]).select("id", "source", "queue", "base", "first", "n", "ids")
    return placed.mapInPandas(run, schema)


def padded_length(used: int, length: int = LENGTH) -> int:
    """Length of a sequence of ``used`` tokens once padded."""
    return used if used and used & (used - 1) == 0 else length

