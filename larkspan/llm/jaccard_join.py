r"""Exact Jaccard join of shingle sets in a metric space.

Jaccard distance is a metric, and most pairs of texts are at distance 1, where no pivot tells them apart. So the join
comes in two parts, both exact.

1. Texts that can have a neighbour. Hashed shingles are dealt by their leading bits, which finds those that another set
   has too. A set within distance 0.2 of another shares at least 0.8 of its shingles, so sets with fewer shared ones
   stand alone. Equal sets collapse to the one with the smallest id. The rest, twice as strict (shared with another
   class), fall into blocks: sets that have a shingle of their prefixes in common, rarest first, are in one block.
2. Blocks in the metric space. A pivot's distances to all sets of its block give its links; sets linked with a pivot
   are one component, and a member ``x`` needs no comparison of its own if every set outside of the component is
   farther from the pivot than ``d(x, pivot) + 0.2``. Blocks beyond ``BLOCK_BYTES`` are first cut into the Voronoi
   regions of several pivots, over all executors: a set goes to its nearest pivot's region and, as a copy, to each
   region whose pivot is at most ``0.4`` farther; regions join on their own, again cut if still too large. A block is cut
   only if its regions shrink: each has at most half of its bytes, all together at most one and a half times as many. So
   the recursion ends after log(bytes) rounds. Where sets lie at middle distances from all pivots, regions don't shrink;
   such a block is joined in tiles instead: its sets, in order of size, fall into slots of bounded bytes, and each two
   slots whose sizes allow a link meet in one task. That is exact, with work that grows with the square of that block.

Only components leave a block, never pairs; links are verified on whole sets of 64-bit shingle hashes.

Defined cases: a null text counts as empty; texts without words have no shingles and no links; with fewer than
``words`` words the whole sequence is the one shingle; rows without an id get a null component; rows that repeat an id with
other texts are documents of their own, each linked by its own text, and there is a row for each row; an empty table gives
no rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.llm.common import encoded, forget, lean, met_by_key, pieces, settle, shingle_sets, slices, text_bytes, text_of, trim, written
from larkspan.llm.components import connected_components

WORDS = 5
#: Similarity of 80 %: 100 * intersection >= 80 * union.
PERCENT = 80
#: Bytes of shingle hashes that one task takes at a time.
PART_BYTES = 12 << 20
BLOCK_BYTES = 32 << 20
PIVOTS = 16
#: Slots of the rank of hashes: their table has at most so many rows, about 40 MB in Spark's hash table.
SLOTS = 1 << 20
#: Tables of a few numbers for each large block are broadcast up to so many rows (about 100 MB), else shuffled.
BROADCAST_ROWS = 1_000_000

_PACKED = "p int, kind int, hashes binary, counts binary, ids binary"
#: Kinds of packed rows: hashes that one set of a group has, or several (then without owners); sizes of sets; hashes of
#: several sets of a group, with their owners.
_MET, _SIZES, _KNOWN = 0, 1, 2


def _pack_ids(ids: np.ndarray) -> bytes:
    """Ids as compressed differences: those of neighbouring rows are often close."""
    return zlib.compress(np.diff(ids.astype("<i8"), prepend=np.int64(0)).tobytes(), 1)


def _unpack_ids(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), "<i8"))


def _scatter(parts: int, groups):
    """Rows of ``_PACKED`` for (ids, sizes, hashes, owners) groups of sets.

    Each distinct hash of a group goes once to the part of its leading bits. Owners of a hash that only one set has go
    with it; a hash that several sets have is known to be shared already, so it goes without owners, and its owners go to
    any part. However many sets share a hash, its part gets a row for each group at most.
    """
    for turn, (ids, sizes, hashes, owners) in enumerate(groups):
        packed, rows, k = _pack_ids(ids), [], len(ids)
        any_part = (turn * 7919 + int(ids[0])) % parts
        order = np.argsort(hashes, kind="stable")
        h, o = hashes[order], owners[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
        times = np.diff(np.append(first, len(h)))
        several = np.repeat(times > 1, times)
        if several.any():
            by_owner = np.argsort(o[several], kind="stable")
            rows.append((any_part, _KNOWN, h[several][by_owner].tobytes(), np.bincount(o[several], minlength=k).astype("<u4").tobytes(), packed))
        u, w = h[first], np.where(times > 1, k, o[first])
        part = ((u >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        order = np.lexsort((w, part))
        u, w, at = u[order], w[order], np.searchsorted(part, np.arange(parts + 1))
        rows += [(int(p), _MET, u[at[p] : at[p + 1]].tobytes(), np.bincount(w[at[p] : at[p + 1]], minlength=k + 1).astype("<u4").tobytes(), packed) for p in range(parts) if at[p] < at[p + 1]]
        rows.append((any_part, _SIZES, b"", sizes.astype("<u4").tobytes(), packed))
        yield pa.RecordBatch.from_pydict(dict(zip(("p", "kind", "hashes", "counts", "ids"), (pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), *[pa.binary()] * 3), strict=True)), strict=True)))


def _gather(rows: pd.DataFrame) -> pd.DataFrame:
    """(id, h): the hashes of a part that other sets have too, by owner; and (id, null, size) of sets."""
    hashes, owners, alone, out = [], [], [], []
    for r in rows.itertuples(index=False):
        ids, counts, own = _unpack_ids(r.ids), np.frombuffer(r.counts, "<u4"), np.frombuffer(r.hashes, np.int64)
        if r.kind == _SIZES:
            out.append(pd.DataFrame({"id": ids, "h": pd.array([None] * len(ids), "Int64"), "n": counts.astype(np.int64)}))
        elif r.kind == _KNOWN:
            out.append(pd.DataFrame({"id": np.repeat(ids, counts), "h": pd.array(own, "Int64"), "n": 0}))
        else:
            hashes.append(own)
            owners.append(np.repeat(np.append(ids, 0), counts))
            alone.append(np.repeat(np.arange(len(counts)) < len(ids), counts))
    if hashes:
        h, o, single = np.concatenate(hashes), np.concatenate(owners), np.concatenate(alone)
        order = np.argsort(h, kind="stable")
        h, o, single = h[order], o[order], single[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        times = np.diff(np.append(first, len(h)))
        shared = np.repeat((times > 1) | ~np.logical_and.reduceat(single, first), times) & single
        out.append(pd.DataFrame({"id": o[shared], "h": pd.array(h[shared], "Int64"), "n": 0}))
        del h, o, single, hashes, owners, alone, order
    made = pd.concat(out)
    trim()
    return made


def _shared(packed: DataFrame, name: str) -> DataFrame:
    """Per id: size of the set (n), and its hashes that other sets have too (shared); written.

    In two jobs, so that the shuffle of all hashes is gone before the shared ones move on.
    """
    found = written(packed.groupBy("p").applyInPandas(_gather, "id long, h long, n long"), "shared-rows")
    settle(packed.sparkSession)
    out = written(found.groupBy("id").agg(F.max(F.when(F.col("h").isNull(), F.col("n"))).alias("n"), F.collect_set("h").alias("shared")), name)
    forget(found)
    return out


def _prefixes(near: DataFrame) -> DataFrame:
    """(id, h): the first shared hashes of each set, rarest first, as many as a neighbour cannot avoid.

    A hash counts as rare by the number of sets in its slot of a fixed number of slots, a rank that is the same for every
    set; hashes that no other set has stand before all.
    """
    each = near.select("id", F.explode("shared").alias("h")).withColumn("slot", F.pmod("h", F.lit(SLOTS)))
    ranks = written(each.groupBy("slot").agg(F.count(F.lit(1)).alias("sets")), "slots")
    room = F.col("n") - F.ceil(F.col("n") * PERCENT / 100.0 - 1e-9) + 1 - (F.col("n") - F.size("shared"))
    ranked = each.join(F.broadcast(ranks), "slot").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("sets", "h"))).alias("ranked"))
    first = ranked.join(near.select("id", F.greatest(room, F.lit(1)).cast("int").alias("room")), "id")
    return first.select("id", F.explode(F.slice("ranked", F.lit(1), F.col("room"))).alias("s")).select("id", F.col("s.h").alias("h"))


def _from_texts(parts: int):
    def run(batches):
        def groups():
            for batch in slices(batches):
                ids, texts = batch.column("id").to_numpy(), encoded(batch.column("text").to_pylist())
                for low, high in pieces(texts):
                    hashes, sizes = shingle_sets(texts[low:high], WORDS)
                    yield ids[low:high], sizes, hashes, np.repeat(np.arange(high - low), sizes)

        return _scatter(parts, groups())

    return run


def _from_sets(parts: int):
    def run(batches):
        def groups():
            for batch in slices(batches):
                lists = batch.column("hs")
                lengths = np.diff(lists.offsets.to_numpy())
                hashes = lists.flatten().to_numpy().view(np.uint64)
                yield batch.column("id").to_numpy(), batch.column("n").to_numpy(), hashes, np.repeat(np.arange(len(lengths)), lengths)

        return _scatter(parts, groups())

    return run


def _near(a, b, common, percent: int = PERCENT):
    return 100 * common >= percent * (a + b - common)


def _distance(a, b, common):
    return 1 - common / np.maximum(a + b - common, 1)


def block_components(ids: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """The smallest id that links reach, for each set of a block, by pivots and the triangle inequality."""
    b, reach = len(ids), 1 - percent / 100 + 1e-9
    lengths = np.array([len(s) for s in sets])
    _, term = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(b), lengths)
    order = np.argsort(term, kind="stable")
    posting, start = owner[order], np.concatenate(([0], np.cumsum(np.bincount(term))))
    own = np.concatenate(([0], np.cumsum(lengths)))
    label, apart = ids.copy(), np.full(b, -1.0)
    for p in range(b):
        if apart[p] > reach:
            continue
        terms = term[own[p] : own[p + 1]]
        count = start[terms + 1] - start[terms]
        places = np.repeat(start[terms] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        common = np.bincount(posting[places], minlength=b)
        linked = np.unique(label[_near(sizes[p], sizes, common, percent) | (np.arange(b) == p)])
        label[np.isin(label, linked)] = linked[0]
        inside, d = label == label[p], _distance(sizes[p], sizes, common)
        nearest = d[~inside].min(initial=np.inf)
        apart[inside] = np.maximum(apart[inside], nearest - d[inside])
        apart[p] = np.inf
    return label


def _blocks_in_memory(rows: pd.DataFrame) -> pd.DataFrame:
    out = []
    for _, g in rows.groupby("block"):
        ids = g["id"].to_numpy(np.int64)
        out.append(pd.DataFrame({"src": ids, "dst": block_components(ids, g["n"].to_numpy(np.int64), [np.asarray(h, np.int64) for h in g["hs"]])}))
    return pd.concat(out) if out else pd.DataFrame({"src": [], "dst": []})


def _to_pivots(_: tuple, docs: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    out = []
    chosen = [(int(i), int(n), np.asarray(h, np.int64)) for i, n, h in zip(pivots["pivot"], pivots["pivot_n"], pivots["pivot_hs"], strict=True)]
    chosen.sort(key=lambda x: x[0])
    for r in docs.itertuples(index=False):
        own = np.asarray(r.hs, np.int64)
        common = np.array([len(np.intersect1d(own, h, assume_unique=True)) for _, _, h in chosen])
        n = np.array([n for _, n, _ in chosen])
        out.append((r.block, r.id, r.n, [i for i, _, _ in chosen], _distance(r.n, n, common).tolist(), _near(r.n, n, common).tolist()))
    return pd.DataFrame(out, columns=["block", "id", "n", "pivots", "d", "near"])


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _tile_links(tile: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Star edges of the components that links between the two slots of a tile make."""
    _, a, b = tile
    rows = rows.sort_values("id")
    ids, sizes, slot = rows["id"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), rows["slot"].to_numpy()
    sets = [np.asarray(h, np.int64) for h in rows["hs"]]
    right = np.flatnonzero(slot == b)
    keys = np.unique(np.concatenate([sets[i] for i in right])) if len(right) else np.empty(0, np.int64)
    term = np.concatenate([np.searchsorted(keys, sets[i]) for i in right]) if len(right) else np.empty(0, np.int64)
    posting = np.repeat(np.arange(len(right)), [len(sets[i]) for i in right])[np.argsort(term, kind="stable")]
    start = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(keys)))))
    label = np.arange(len(ids))
    for x in np.flatnonzero(slot == a):
        at = np.minimum(np.searchsorted(keys, sets[x]), max(0, len(keys) - 1))
        at = at[keys[at] == sets[x]] if len(keys) else at[:0]
        common = np.bincount(np.concatenate([posting[start[t] : start[t + 1]] for t in at]), minlength=len(right)) if len(at) else np.zeros(len(right), np.int64)
        linked = np.unique(label[np.append(right[_near(sizes[x], sizes[right], common)], x)])
        if len(linked) > 1:
            label[np.isin(label, linked)] = linked[0]
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return pd.DataFrame({"src": ids[moved], "dst": ids[label[moved]]})


def _size_class(n: Column) -> Column:
    """Steps of 9 %: at most some 160 for sets of up to a million shingles."""
    return F.floor(8 * F.log2(n.cast("double"))).cast("int")


def tile_links(big: DataFrame, slot_bytes: int) -> DataFrame:
    """Edges of all links in each block, exactly: any two sets of sizes that allow a link meet in one tile."""
    sized = big.withColumn("class", _size_class(F.col("n")))
    classes = sized.groupBy("block", "class").agg(F.sum(8 * F.col("n")).alias("bytes"))
    ahead = Window.partitionBy("block").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)  # some 160 rows a block
    classes = written(classes.withColumn("before", F.coalesce(F.sum("bytes").over(ahead), F.lit(0))), "size-classes")
    spread = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) / float(1 << 20)
    laid = written(sized.join(_few(classes), ["block", "class"]).withColumn("slot", F.floor((F.col("before") + spread * F.col("bytes")) / slot_bytes)).select("block", "id", "n", "hs", "slot"), "slots")
    slots = written(laid.groupBy("block", "slot").agg(F.min("n").alias("least"), F.max("n").alias("most")), "slot-sizes")
    a, b = (slots.select("block", *[F.col(c).alias(f"{c}_{side}") for c in ("slot", "least", "most")]) for side in "ab")
    fits = (F.col("slot_a") <= F.col("slot_b")) & (100 * F.col("most_a") >= PERCENT * F.col("least_b")) & (100 * F.col("most_b") >= PERCENT * F.col("least_a"))
    tiles = a.join(_few(b), "block").where(fits).select("block", F.col("slot_a").alias("a"), F.col("slot_b").alias("b"))
    visits = tiles.select("block", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("slot"))
    return laid.join(visits.hint("shuffle_hash"), ["block", "slot"]).groupBy("block", "a", "b").applyInPandas(_tile_links, "src long, dst long")


def _cut(big: DataFrame, block_bytes: int, pivots: int) -> tuple[list[DataFrame], DataFrame]:
    """One round over blocks that are too large: written edges, and (block, id, n, hs) rows of the regions."""
    reach = 1 - PERCENT / 100 + 1e-9
    chosen = big.groupBy("block").agg(F.min_by("id", F.struct(F.xxhash64("id"), "id")).alias("first"), F.sum(8 * F.col("n")).alias("bytes"), F.count(F.lit(1)).alias("sets"))
    chosen = written(chosen, "large-blocks")
    # About four times as many candidates as pivots, by the hash of their ids; of these the first ones, and one for certain.
    lot = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30) * F.col("sets") < 4 * pivots
    some = big.select("block", "id").join(_few(chosen.select("block", "sets", "first")), "block").where(lot | (F.col("id") == F.col("first")))
    picked = some.groupBy("block").agg(F.slice(F.sort_array(F.collect_list(F.struct(F.xxhash64("id").alias("h"), "id"))), 1, pivots).alias("picked")).select("block", F.explode("picked.id").alias("id"))
    sides = chosen.select("block", F.ceil(F.col("bytes") * 4 / block_bytes).cast("int").alias("salts"))
    pivot = picked.join(big, ["block", "id"]).join(sides, "block").select(F.col("block").alias("at"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("side"), F.col("id").alias("pivot"), F.col("n").alias("pivot_n"), F.col("hs").alias("pivot_hs"))
    docs = big.join(_few(sides), "block").withColumn("salt", F.pmod(F.xxhash64("id", F.lit(1)), F.col("salts")).cast("int"))
    far = written(
        docs.groupBy("block", "salt").cogroup(pivot.groupBy("at", "side")).applyInPandas(_to_pivots, "block string, id long, n long, pivots array<long>, d array<double>, near array<boolean>"), "pivot-distances"
    )
    each = far.select("block", "id", F.explode(F.arrays_zip("pivots", "d", "near")).alias("x")).select("block", "id", "x.*")
    edges = written(each.where("near").select(F.col("id").alias("src"), F.col("pivots").alias("dst")), "links")
    outside = written(each.where("not near").groupBy("block", "pivots").agg(F.min("d").alias("outside")), "outside")
    settled = each.join(_few(outside), ["block", "pivots"], "left").where(F.col("near") & (F.col("outside").isNull() | (F.col("outside") > F.col("d") + reach)) | (F.col("id") == F.col("pivots"))).select("block", "id").distinct()
    left = written(far.join(settled, ["block", "id"], "left_anti"), "unsettled")
    home = left.select("block", "id", "n", F.array_min("d").alias("least"), F.explode(F.arrays_zip("pivots", "d")).alias("x")).where(F.col("x.d") <= F.col("least") + 2 * reach)
    home = home.select("block", "id", "n", F.concat_ws("/", "block", F.col("x.pivots").cast("string")).alias("region"))
    regions = home.groupBy("block", "region").agg(F.sum(8 * F.col("n")).alias("own")).groupBy("block").agg(F.sum("own").alias("copies"), F.max("own").alias("largest"))
    shrinks = (2 * F.col("largest") <= F.col("bytes")) & (2 * F.col("copies") <= 3 * F.col("bytes"))
    judged = written(regions.join(chosen, "block").select("block", shrinks.alias("shrinks")), "judged-blocks")
    met = home.join(_few(judged.where("shrinks").select("block")), "block").join(big.select("block", "id", "hs"), ["block", "id"]).select(F.col("region").alias("block"), "id", "n", "hs")
    links = [edges]
    if not judged.where("not shrinks").isEmpty():
        stuck = left.select("block", "id").join(_few(judged.where("not shrinks").select("block")), "block").join(big, ["block", "id"])
        links.append(written(tile_links(stuck.select("block", "id", "n", "hs"), max(1, block_bytes // 4)), "links"))
    return links, met


def link_blocks(blocked: DataFrame, block_bytes: int = BLOCK_BYTES, pivots: int = PIVOTS) -> DataFrame:
    """Edges (src, dst) whose components are those of the links in the blocks; ``blocked``: (block, id, n, hs), written."""
    edges = []
    while True:
        large = written(blocked.groupBy("block").agg(F.sum(8 * F.col("n")).alias("bytes")).where(F.col("bytes") > block_bytes).select("block"), "large-blocks")
        none = large.isEmpty()
        small = blocked if none else blocked.join(_few(large), "block", "left_anti")
        total = small.agg(F.sum(8 * F.col("n"))).first()[0] or 0
        buckets = max(1, -(-4 * total // block_bytes))
        dealt = small.withColumn("bucket", F.pmod(F.xxhash64("block"), F.lit(buckets))).groupBy("bucket")
        edges.append(written(dealt.applyInPandas(_blocks_in_memory, "src long, dst long"), "links"))
        if none:
            break
        stars, regions = _cut(blocked.join(_few(large), "block"), block_bytes, pivots)
        edges += stars
        blocked = written(regions, "regions")
    out = edges[0]
    for e in edges[1:]:
        out = out.union(e)
    return out


def _components(known: DataFrame, block_bytes: int, pivots: int, part_bytes: int) -> DataFrame:
    """(id, n, component) of (id, text) rows; rows that repeat an id have equal texts."""
    parts = max(1, -(-2 * text_bytes(known) // part_bytes))
    first = _shared(known.mapInArrow(_from_texts(parts), _PACKED), "shared-shingles")
    sizes = first.select("id", "n")
    # Sets that can have a neighbour; equal sets collapse.
    suspects = first.where((F.col("n") > 0) & (100 * F.size("shared") >= PERCENT * F.col("n"))).select("id", "n", F.col("shared").alias("hs"))
    keyed = suspects.withColumn("whole", F.size("hs") == F.col("n")).withColumn("k1", F.when(F.col("whole"), F.xxhash64(F.sort_array("hs"))).otherwise(F.col("id"))).withColumn("k2", F.when(F.col("whole"), F.xxhash64(F.lit(1), F.sort_array("hs"))).otherwise(F.lit(0)))
    keys = ["n", "whole", "k1", "k2"]
    classes = written(keyed.groupBy(*keys).agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("copies")), "classes")
    n_suspects, held = classes.agg(F.sum("copies"), F.sum("n")).first()
    members = written(met_by_key(keyed.select("id", *keys), classes, keys, "copies", n_suspects or 0).select("id", "class"), "class-members")
    ahead = suspects.join(classes.select(F.col("class").alias("id")), "id", "left_semi")
    again = max(1, -(-16 * (held or 0) // part_bytes))
    near = _shared(ahead.mapInArrow(_from_sets(again), _PACKED), "near-sets").where(100 * F.size("shared") >= PERCENT * F.col("n"))
    # Blocks: prefixes, rarest shingles first; shingles that no other class has stand before them.
    prefix = written(_prefixes(near), "prefixes")
    hubs = written(prefix.groupBy("h").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("sets")).where(F.col("sets") > 1), "hubs")
    n_met = hubs.agg(F.sum("sets")).first()[0] or 0
    block = connected_components(met_by_key(prefix, hubs, ["h"], "sets", n_met).select(F.col("id").alias("src"), F.col("hub").alias("dst")))
    blocked = near.select("id", "n", F.col("shared").alias("hs")).join(block, F.col("id") == F.col("node")).select(F.col("component").cast("string").alias("block"), "id", "n", "hs")
    links = link_blocks(written(blocked, "blocks"), block_bytes, pivots)
    found = connected_components(links).withColumnRenamed("node", "class")
    of_class = written(classes.select("class", "copies").join(found, "class", "left").select("class", "copies", F.coalesce("component", "class").alias("component")), "class-components")
    named = met_by_key(members, of_class, ["class"], "copies", n_suspects or 0).select("id", "component")
    return sizes.join(named, "id", "left").select("id", "n", F.coalesce("component", "id").alias("component"))


def _components_of_texts(known: DataFrame, **settings) -> DataFrame:
    """(id, n, component), a row for each row, where ids may repeat with different texts: each (id, text) gets a key."""
    rows = known.withColumn("text_key", F.xxhash64("text"))
    keys = written(rows.select("id", "text_key").distinct().withColumn("key", F.monotonically_increasing_id()), "document-keys")
    found = written(_components(rows.join(keys, ["id", "text_key"]).select(F.col("key").alias("id"), "text"), **settings).withColumnRenamed("id", "key").withColumnRenamed("component", "group"), "document-groups")
    least = written(found.join(keys, "key").groupBy("group").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("members")), "group-ids")
    named = met_by_key(found, least, ["group"], "members", found.count()).select("key", "n", "component")
    return rows.select("id", "text_key").join(keys, ["id", "text_key"]).join(named, "key").select("id", "n", "component")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, pivots: int = PIVOTS, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: its id, n_shingles, component_id (the smallest id that links reach)."""
    lean(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    known = rows.where(F.col("id").isNotNull())
    settings = {"block_bytes": block_bytes, "pivots": pivots, "part_bytes": part_bytes}
    once = known.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1).isEmpty()
    found = _components(known, **settings) if once else _components_of_texts(known, **settings)
    out = found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))

    @F.pandas_udf("long")
    def set_size(text: pd.Series) -> pd.Series:
        return pd.Series(shingle_sets(encoded(list(text)), WORDS)[1])

    return out.unionByName(rows.where(F.col("id").isNull()).select(F.col("id").alias(id_col), set_size("text").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))
