r"""Removal of long repeated byte strings with a logarithmic family of sparse suffix indexes.

Suffixes start at content-defined anchors: the anchor of a 200-byte window is its leftmost smallest hashed 50-byte
string, so equal windows have equal anchors, and each window belongs to exactly one. The windows of one anchor make up its
context. Batches of documents come one after the other. A batch's index holds its distinct contexts, in the order of the
fingerprints of their 50-byte prefix and of the whole context (not of their bytes: removal rests on which strings are equal,
and equal ones are neighbours in this order too), each with its number and one of its places. The family keeps indexes in
levels of 1, 2, 4, ... batches. A new batch is scanned against all levels in one merge of the sorted indexes, which tells
the contexts and the prefixes that it has in common with what is there or with itself; the levels below the first empty one
are merged with it into that one by the same pass. So a context is found at the batch in which its second copy comes, and a
batch is written log(batches) times; with ``BATCHES`` = 5 two levels stand at the end.

- A context found more than once: all its windows are repeated.
- Contexts that share the 50-byte prefix but differ: their windows are hashed (one place of each distinct context) and
  compared. Prefixes with more than ``HOT_CONTEXTS`` contexts are compared by their windows' hashes over all tasks, other
  ones in buckets of bounded bytes.

Every window's repetition is judged on the input as given; a document's removed bytes are the union of its repeated
windows. Fingerprints of contexts and windows are compared with their prefix's, 128 bits in all (power series modulo 2 ** 64, which
are sound for strings of this length: contexts have at most 350 bytes).

Defined cases: a null text counts as empty; texts of fewer than ``WINDOW`` bytes lose nothing; rows that repeat an id are
documents of their own (equal rows repeat each other); a null id is returned as such; an empty table gives no rows; other
columns are not read. Texts beyond ``SEGMENT`` bytes are read in segments that overlap by a window.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import _INVERSE, encoded, forget, lean, met_by_key, mix, powers, prefix_hashes, range_hashes, settle, slices, text_of, written

WINDOW = 200
PREFIX = 50
SEGMENT = 1 << 20
BATCHES = 5
HOT_CONTEXTS = 20_000
BUCKET_BYTES = 8 << 20
_PLACE_BITS = np.uint64(24)  # positions in a segment; the other bits of a hash decide the order
_ANCHORS = "id long, th long, s0 int, s1 int, h50 long, hu long"
#: Where a context of a merge stands: in the new batch, in a level that is merged with it, in another level.
_NEW, _MERGED, _STANDS = 1, 2, 4


def _segments(texts: list[bytes]):
    """(rows, starts in their texts, bytes) of joined texts; long texts in overlapping segments."""
    rows, at, held, size = [], [], [], 0
    for i, t in enumerate(texts):
        for low in range(0, max(1, len(t) - WINDOW + 1), SEGMENT):
            part = t[low : low + SEGMENT + WINDOW - 1]
            if len(part) < WINDOW:
                continue
            if held and size + len(part) > SEGMENT:
                yield rows, at, held
                rows, at, held, size = [], [], [], 0
            rows.append(i)
            at.append(low)
            held.append(part)
            size += len(part)
    if held:
        yield rows, at, held


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Row, first and last window start in it, prefix and context hash of each anchor."""
    out = [tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))]
    span = WINDOW - PREFIX + 1
    for rows, at, held in _segments(texts):
        data = np.frombuffer(b"".join(held), np.uint8)
        n, sizes = len(data), np.array([len(x) for x in held])
        ends = np.cumsum(sizes)
        sums = prefix_hashes(data)
        h = mix((sums[PREFIX:] - sums[:-PREFIX]) * powers(_INVERSE, n)[: n - PREFIX + 1])
        key = (h >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
        grid = np.concatenate((key, np.full(-len(key) % span + span, ~np.uint64(0)))).reshape(-1, span)
        ahead, behind = np.minimum.accumulate(grid, axis=1).ravel(), np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        start = np.arange(n - WINDOW + 1)
        part = np.repeat(np.arange(len(held)), sizes)[: len(start)]
        inside = start + WINDOW <= ends[part]
        start, part = start[inside], part[inside]
        anchor = (np.minimum(behind[start], ahead[start + span - 1]) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))))
        s0, s1 = start[new], start[np.append(new[1:], len(start)) - 1]
        part, anchor = part[new], anchor[new]
        shift = np.array(at)[part] - (ends - sizes)[part]
        out.append((np.array(rows)[part], s0 + shift, s1 + shift, h[anchor], range_hashes(sums, s0, s1 + WINDOW)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    own = docs.select(F.col(id_col).cast("long").alias("own"), text_of(text_col).alias("text"))
    return own.withColumn("id", F.coalesce("own", F.lit(-1 << 63))).withColumn("th", F.xxhash64("text"))


def find_anchors(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in slices(batches):
            row, s0, s1, h, u = anchors(encoded(batch.column("text").to_pylist()))
            ids, th = batch.column("id").to_numpy(), batch.column("th").to_numpy()
            for low in range(0, len(row), 1 << 18):
                k = slice(low, low + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(ids[row[k]]), pa.array(th[row[k]]), pa.array(s0[k].astype(np.int32)), pa.array(s1[k].astype(np.int32)), pa.array(h[k].view(np.int64)), pa.array(u[k].view(np.int64))], ["id", "th", "s0", "s1", "h50", "hu"])

    return docs.select("id", "th", "text").mapInArrow(run, _ANCHORS)


class IndexFamily:
    """Levels of distinct contexts (h50, hu, n, row); ``levels[k]`` holds those of ``2 ** k`` batches, or None. ``row`` is
    the least number of an anchor with the context.

    ``whole``: (h50, hu, n) of contexts found again, by batch; ``prefixes``: (h50, different) of prefixes that different
    contexts share. Where several batches tell of one, the greatest number is that of all.
    """

    def __init__(self) -> None:
        self.levels: list[DataFrame | None] = []
        self.whole: list[DataFrame] = []
        self.prefixes: list[DataFrame] = []

    def append(self, anchors_of_batch: DataFrame) -> None:
        k = next((i for i, x in enumerate(self.levels) if x is None), len(self.levels))
        merged, stands = self.levels[:k], [x for x in self.levels[k:] if x is not None]
        rows = anchors_of_batch.select("h50", "hu", F.lit(1).cast("long").alias("n"), "row", F.lit(_NEW).alias("tag"))
        for tag, levels in ((_MERGED, merged), (_STANDS, stands)):
            for x in levels:
                rows = rows.union(x.withColumn("tag", F.lit(tag)))
        own = F.col("tag") != _STANDS
        scan = rows.groupBy("h50", "hu").agg(F.bit_or("tag").alias("tags"), F.sum(F.when(own, F.col("n"))).alias("n"), F.sum("n").alias("copies"), F.min(F.when(own, F.col("row"))).alias("row"))
        scan = written(scan.sortWithinPartitions("h50", "hu"), "suffix-level")
        fresh = F.col("tags").bitwiseAND(_NEW) > 0
        self.whole.append(written(scan.where(fresh & (F.col("copies") > 1)).select("h50", "hu", F.col("copies").alias("n")), "found-contexts"))
        by_prefix = scan.groupBy("h50").agg(F.count(F.lit(1)).alias("different"), F.bit_or("tags").alias("tags"))
        self.prefixes.append(written(by_prefix.where((F.col("different") > 1) & fresh).select("h50", "different"), "found-prefixes"))
        level = scan.where("n is not null").select("h50", "hu", "n", "row")
        level._larkspan_path = scan._larkspan_path
        forget(*merged)
        self.levels = [None] * k + [level] + self.levels[k + 1 :]

    def matches(self) -> DataFrame:
        """(h50, hu, n, row, different) of the contexts found again (n > 1) and of those that share a prefix with another
        one (``different`` of them, and the ``row`` of an anchor)."""
        whole = reduce(DataFrame.union, self.whole).groupBy("h50", "hu").agg(F.max("n").alias("n"))
        shared = written(reduce(DataFrame.union, self.prefixes).groupBy("h50").agg(F.max("different").alias("different")), "shared-prefixes")
        levels = reduce(DataFrame.union, [x for x in self.levels if x is not None])
        contexts = levels.join(shared.select("h50"), "h50", "left_semi").groupBy("h50", "hu").agg(F.sum("n").alias("n"), F.min("row").alias("row"))
        total = shared.agg(F.sum("different")).first()[0] or 0
        unsure = met_by_key(written(contexts, "contexts-of-prefixes"), shared.withColumn("weight", F.col("different")), ["h50"], "weight", total)
        both = whole.select("h50", "hu", "n", F.lit(None).cast("long").alias("row"), F.lit(None).cast("long").alias("different")).unionByName(unsure)
        return both.groupBy("h50", "hu").agg(F.max("n").alias("n"), F.max("row").alias("row"), F.max("different").alias("different"))

    def tables(self) -> list[DataFrame]:
        return [x for x in (*self.levels, *self.whole, *self.prefixes) if x is not None]


def _window_hashes(texts: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, context and place in it of each context's windows."""
    data, first = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])[:-1]
    sums = prefix_hashes(data)
    which = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = first[which] + place
    return range_hashes(sums, start, start + WINDOW), which, place


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Removed ranges of the contexts of a bucket that occur once themselves."""
    counts = (rows["s1"] - rows["s0"] + 1).to_numpy(np.int64)
    h, which, place = _window_hashes(list(rows["context"]), counts)
    _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
    again = (times[inverse] > 1) & (rows["n"].to_numpy()[which] == 1)
    which, place = which[again], place[again]
    hit, first = np.unique(which, return_index=True)
    last = np.append(first[1:], len(which)) - 1
    s0 = rows["s0"].to_numpy(np.int64)[hit]
    return pd.DataFrame({"id": rows["id"].to_numpy()[hit], "th": rows["th"].to_numpy()[hit], "low": s0 + place[first], "high": s0 + place[last] + WINDOW}) if len(hit) else pd.DataFrame({"id": [], "th": [], "low": [], "high": []})


def _explode(batches):
    for batch in batches:
        for low in range(0, len(batch), 2048):
            rows = batch.iloc[low : low + 2048]
            counts = (rows["s1"] - rows["s0"] + 1).to_numpy(np.int64)
            h, which, place = _window_hashes(list(rows["context"]), counts)
            yield pd.DataFrame({"h50": rows["h50"].to_numpy()[which], "h": h.view(np.int64), "id": rows["id"].to_numpy()[which], "th": rows["th"].to_numpy()[which], "n": rows["n"].to_numpy()[which], "s": rows["s0"].to_numpy(np.int64)[which] + place})


def _cut(batches):
    for batch in batches:
        out = []
        for own, text, ranges in zip(batch["own"], encoded(batch["text"]), batch["ranges"], strict=True):
            spans: list[list[int]] = []
            for r in sorted((r["low"], r["high"]) for r in (ranges if ranges is not None else ())):
                if spans and r[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], r[1])
                else:
                    spans.append([*r])
            edges = [0, *(x for s in spans for x in s), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            out.append((own, len(text), len(text) - len(kept), [{"low": a, "high": b} for a, b in spans], hashlib.sha256(kept).hexdigest()))
        table = pd.DataFrame(out, columns=["own", "n_bytes", "n_removed", "spans", "kept_sha256"])
        yield table.assign(own=pd.array([None if pd.isna(x) else int(x) for x in table["own"]], "Int64"))


def repeated_ranges(docs: DataFrame, batches: int = BATCHES, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(id, th, low, high): byte ranges of ``_keyed`` documents that repeated windows cover; ranges may overlap."""
    found = written(find_anchors(docs).withColumn("row", F.monotonically_increasing_id()), "anchors")
    family = IndexFamily()
    for b in range(batches):
        family.append(found.where(F.pmod(F.xxhash64("id", "th"), F.lit(batches)) == b))
    keys = written(family.matches().withColumnsRenamed({"row": "one"}).withColumn("weight", F.col("n")), "found-contexts")
    total = keys.agg(F.sum("n")).first()[0] or 0
    met = met_by_key(found, keys, ["h50", "hu"], "weight", total)
    # Of anchors with a context that is found again, the range; of a context that shares its prefix, one anchor.
    met = written(met.where("n > 1 or row = one").select("id", "th", "s0", "s1", "h50", "n", F.when(F.col("row") == F.col("one"), F.col("different")).alias("different")), "met-anchors")
    forget(found, keys, *family.tables())
    sure = met.where("n > 1").select("id", "th", F.col("s0").cast("long").alias("low"), (F.col("s1") + WINDOW).cast("long").alias("high"))
    unsure = met.where("different is not null")
    places = unsure.groupBy("id", "th").agg(F.collect_list(F.struct("h50", "n", "different", "s0", "s1")).alias("places"))

    def cut(batches):
        for batch in slices(batches, 512):
            lists, texts = batch.column("places"), encoded(batch.column("text").to_pylist())
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            field = {k: flat.field(k) for k in ("h50", "n", "different", "s0", "s1")}
            context = [texts[o][a : b + WINDOW] for o, a, b in zip(owner.tolist(), field["s0"].to_pylist(), field["s1"].to_pylist(), strict=True)]
            keys = {k: batch.column(k).take(pa.array(owner)) for k in ("id", "th")}
            yield pa.RecordBatch.from_pydict(field | keys | {"context": pa.array(context, pa.binary())})

    schema = "h50 long, n long, different long, s0 int, s1 int, id long, th long, context binary"
    known = written(docs.join(places, ["id", "th"]).select("id", "th", "text", "places").mapInArrow(cut, schema), "contexts")
    settle(docs.sparkSession)  # the shuffle of the texts
    few = known.where(F.col("different") <= hot_contexts)
    size = few.agg(F.sum(F.octet_length("context"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    ranges = "id long, th long, low long, high long"
    near = few.withColumn("bucket", F.pmod(F.xxhash64("h50"), F.lit(buckets))).groupBy("bucket").applyInPandas(_compare, ranges)
    out = sure.union(near)
    if not known.where(F.col("different") > hot_contexts).isEmpty():
        windows = written(known.where(F.col("different") > hot_contexts).mapInPandas(_explode, "h50 long, h long, id long, th long, n long, s long"), "hot-windows")
        again = windows.groupBy("h50", "h").agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
        out = out.union(windows.where("n = 1").join(again, ["h50", "h"]).select("id", "th", F.col("s").alias("low"), (F.col("s") + WINDOW).alias("high")))
    return out


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """Per document: id, n_bytes, n_removed, spans (maximal removed ranges of bytes), kept_sha256."""
    lean(docs.sparkSession)
    own = _keyed(docs, id_col, text_col)
    ranges = repeated_ranges(own, batches, hot_contexts).groupBy("id", "th").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    return own.join(ranges, ["id", "th"], "left").select("own", "text", "ranges").mapInPandas(_cut, "own long, n_bytes long, n_removed long, spans array<struct<low: long, high: long>>, kept_sha256 string").withColumnRenamed("own", id_col)
