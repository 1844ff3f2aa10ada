r"""Main text of web pages by differencing against the page with the nearest URL.

A page's text falls into blocks (block elements; line breaks inside a block are white space); elements that say that they
are no text (nav, footer, aside, form, scripts, adverts, comments by class or role, ...) go as they are read. Then, within
a host, pages are ordered by path, a page's mate is the neighbour with the longer common prefix (the former one if
equal), the two pages' blocks are aligned by a longest common subsequence, and the shared blocks are deleted. This is done
for every page. Two kinds of evidence keep a shared block:

- Markup: blocks inside ``article`` or ``main`` are the page's own words (and then blocks outside of them are not). Such a
  block goes only if the mate is another article (less than half of the characters are shared; near copies of one article
  share nearly all) and the block stands on no other host: a site's template is its own, a phrase that several sites
  have is not.
- Without such markup every shared block goes.

Neighbours are found on a range-partitioned table of keys, with each partition's first and last key known to all (two
rows a partition), so a host of any size spreads over many tasks. Pages meet their mates by 64-bit hashes of the blocks;
texts move only to the few pages that lose a block.

Defined cases: null html counts as empty and gives an empty text; a null or odd URL has the host and path that can be
read, else ''; a page alone on its host loses nothing to differencing; equal URLs are ordered by id; there is one row for
each row, also for repeated and null ids; pages of very many blocks are aligned in linear space; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import encoded, lean, met_by_key, slices, span_hashes, without_spans, written

_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*?"""
_RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|textarea|select|button"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:svg|math)(?=[\s/]){_ATTRS}/>|<({_RAW})(?=[\s/>]){_ATTRS}>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({_ATTRS})>|<[!?/][^>]*>?|[^<]+|<", re.S | re.I
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_GONE = frozenset("head title nav footer aside form menu dialog".split())
#: Class names, ids and roles of what is never an article, however much text it holds.
_NEVER = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup comment comments commentlist disqus respond reply replies".split())
#: Names that a page may also give to what holds its text.
_RARELY = frozenset("notice notices alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead share sharing social related recommended widget pagination pager toolbar skip search login contentinfo complementary".split())
#: Parts of compound names that say nothing: ``ad-slot``, ``comment-list``.
_NEUTRAL = frozenset("area bar block bottom box container form group inner item items left link links list outer panel right row section site slot top unit wrap wrapper".split())
_SPACE = re.compile(r"\s+")
_FREE, _WEAK, _STRONG = 0, 1, 2


def _name_kind(name: str) -> int:
    parts = [w for w in re.split(r"[^a-z]+", name.lower()) if w]
    if not parts or any(w not in _NEVER and w not in _RARELY and w not in _NEUTRAL for w in parts):
        return _FREE
    return _STRONG if any(w in _NEVER for w in parts) else _WEAK if any(w in _RARELY for w in parts) else _FREE


def _unwanted(tag: str, attrs: str, in_article: bool) -> int:
    """How sure it is that an element is no text of the page: by its tag, by hiding, or by a whole class name, id or role.

    Names count on block elements only, as inline ones are parts of sentences.
    """
    if tag in _GONE or tag == "header" and not in_article:
        return _STRONG
    if not attrs or tag in ("html", "body", "article", "main"):
        return _FREE
    if _HIDDEN.search(attrs):
        return _STRONG
    if tag not in _BLOCKS:
        return _FREE
    return max((_name_kind(w) for m in _NAMES.finditer(attrs) for w in (m[2] or m[3] or m[4] or "").split()), default=_FREE)


def blocks(html: str) -> tuple[list[str], list[str]]:
    """The blocks inside of article or main elements, and all blocks, both without elements that say they are no text.

    An element that only a name of ``_RARELY`` marks stays if it holds more than half of the page's text.
    """
    stack: list[tuple[str, int, bool]] = []  # tag, kind or number of a weakly marked element, article
    found: list[tuple[str, bool, tuple[int, ...]]] = []  # block, in an article, weakly marked elements around it
    held: list[str] = []
    weak: list[int] = []
    gone, article, n_weak = 0, 0, 0

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", unescape("".join(held))).strip()
            held.clear()
            if text:
                found.append((text, article > 0, tuple(weak)))

    def pop() -> None:
        nonlocal gone, article
        _, kind, main = stack.pop()
        if kind == -_STRONG:
            gone -= 1
        elif kind > 0:
            weak.pop()
        article -= main

    for m in _TOKEN.finditer(html):
        tag = m[3]
        if tag is None:
            text = m[0]
            if not gone and (text[0] != "<" or len(text) == 1):
                held.append(text)
            continue
        tag = tag.lower()
        block = tag in _BLOCKS
        if block:
            flush()
        elif tag == "br" and not gone:
            held.append(" ")
        if m[2]:
            if any(t == tag for t, _, _ in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in _VOID or m[4].endswith("/"):
            continue
        if block:  # an open paragraph ends where the next block begins
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in _BLOCKS:
                    break
        kind, main = _unwanted(tag, m[4], bool(article)), tag in ("article", "main")
        if kind == _STRONG:
            gone += 1
        elif kind == _WEAK:
            n_weak += 1
            weak.append(n_weak)
        stack.append((tag, -_STRONG if kind == _STRONG else n_weak if kind == _WEAK else 0, main))
        article += main
    flush()
    if n_weak:
        total, mass = sum(len(t) for t, _, _ in found), [0] * (n_weak + 1)
        for t, _, around in found:
            for e in around:
                mass[e] += len(t)
        found = [x for x in found if all(2 * mass[e] > total for e in x[2])]
    return [t for t, inside, _ in found if inside], [t for t, _, _ in found]


def place(url: str | None) -> tuple[str, str]:
    """Host without www., and path without query, fragment and trailing slash."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").removeprefix("www."), parts.path.rstrip("/")
    except ValueError:
        return "", ""


#: Bits of an alignment's table that are held at a time (32 MB).
TABLE_BITS = 1 << 28


def _rows(a: list, b: list) -> list[int]:
    """Bit rows of the alignment: the zeros among the lowest j bits of row i are the length for a[:i] and b[:j]."""
    masks: dict = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full]
    for x in a:
        v = rows[-1]
        u = v & masks.get(x, 0)
        rows.append((v + u | v - u) & full)
    return rows


def _last_row(a: list, b: list) -> np.ndarray:
    """Lengths for a and each b[:j], with one bit row held at a time."""
    masks: dict = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << j
    v = full = (1 << len(b)) - 1
    for x in a:
        if m := masks.get(x):
            u = v & m
            v = (v + u | v - u) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _aligned(a: list, b: list, at: int, out: set[int], table_bits: int) -> None:
    if not a or not b:
        return
    if len(a) * len(b) > table_bits and len(a) > 1:  # Hirschberg: the middle of a meets b where both halves match most
        half = len(a) // 2
        head, tail = _last_row(a[:half], b), _last_row(a[half:][::-1], b[::-1])[::-1]
        j = int((head + tail).argmax())
        _aligned(a[:half], b[:j], at, out, table_bits)
        _aligned(a[half:], b[j:], at + half, out, table_bits)
        return
    rows, j = _rows(a, b), len(b)
    for i in range(len(a), 0, -1):
        low = (1 << j) - 1
        lost = j - (rows[i] & low).bit_count()
        if lost > j - (rows[i - 1] & low).bit_count():
            out.add(at + i - 1)
            while j - (rows[i] & (1 << j) - 1).bit_count() == lost:
                j -= 1


def shared_lines(a: list, b: list, table_bits: int = TABLE_BITS) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, always the same one."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    out = {*range(low), *range(len(a) - high, len(a))}
    a, b = a[low : len(a) - high], b[low : len(b) - high]
    both = set(a) & set(b)
    places = [i for i, x in enumerate(a) if x in both]
    found: set[int] = set()
    _aligned([a[i] for i in places], [x for x in b if x in both], 0, found, table_bits)
    return out | {low + places[i] for i in found}


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def mates(keys: DataFrame) -> DataFrame:
    """(id, mate): the page of the same host with the nearest path; ``keys``: (id, host, path)."""
    spark = keys.sparkSession
    laid = written(keys.repartitionByRange("host", "path", "id").sortWithinPartitions("host", "path", "id").withColumn("part", F.spark_partition_id()), "page-keys")
    key = F.struct("host", "path", "id")
    edges = [r.asDict(recursive=True) for r in laid.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last")).orderBy("part").collect()]  # two keys for each partition
    before = {b["part"]: a["last"] for a, b in zip(edges, edges[1:], strict=False)}
    after = {a["part"]: b["first"] for a, b in zip(edges, edges[1:], strict=False)}

    def nearest(prior, own, then):
        near = [(x, _prefix(own[1], x[1])) for x in (prior, then) if x is not None and x[0] == own[0]]
        return max(near, key=lambda x: x[1])[0][2] if near else None

    def run(batches):
        prior = own = part = None
        turned = lambda e: None if e is None else (e["host"], e["path"], e["id"])
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                new = (r.host, r.path, r.id)
                if own is None or r.part != part:
                    if own is not None:
                        out.append((own[2], nearest(prior, own, turned(after.get(part)))))
                    prior, part = turned(before.get(r.part)), r.part
                else:
                    out.append((own[2], nearest(prior, own, new)))
                    prior = own
                own = new
            yield pd.DataFrame({"id": [i for i, _ in out], "mate": pd.array([m for _, m in out], "Int64")})
        if own is not None:
            yield pd.DataFrame({"id": [own[2]], "mate": pd.array([nearest(prior, own, turned(after.get(part)))], "Int64")})

    # one task for each part, in order: the sort is short, as the parts' rows lie sorted already
    return spark.read.schema(laid.schema).parquet(laid._larkspan_path).repartition(max(1, len(edges)), "part").sortWithinPartitions("part", "host", "path", "id").mapInPandas(run, "id long, mate long")


#: Pages that lose blocks are broadcast up to so many lost blocks (about 50 MB); beyond, texts are shuffled to them.
BROADCAST_LOST = 1_000_000


def line_keys(lines: list[str]) -> np.ndarray:
    """64-bit hashes of blocks."""
    own = [x + b"\n" for x in encoded(lines)]  # a block is not empty and holds no line feed
    if not own:
        return np.empty(0, np.int64)
    end = np.cumsum([len(x) for x in own])
    return span_hashes(np.frombuffer(b"".join(own), np.uint8), np.concatenate(([0], end[:-1])), end).view(np.int64)


def _align(batches):
    """Shared places of each page and its mate that are not kept as one article's near copies."""
    for batch in batches:
        out = []
        for r in batch.itertuples(index=False):
            own = r.keys.tolist()
            shared = sorted(shared_lines(own, r.mate_keys.tolist()))
            if r.marked and 2 * sum(r.sizes[i] for i in shared) >= sum(r.sizes):
                shared = []
            out += [(r.row, r.marked, i, own[i]) for i in shared]
        yield pd.DataFrame(out, columns=["row", "marked", "place", "key"])


def template_lines(found: DataFrame) -> DataFrame:
    """(row, place): blocks that differencing deletes; ``found``: written (row, host, path, marked, keys, sizes)."""
    pairs = mates(found.select(F.col("row").alias("id"), "host", "path"))
    mate = found.select(F.col("row").alias("mate"), F.col("keys").alias("mate_keys"))
    own = found.select("row", "marked", "keys", "sizes")
    met = own.join(pairs.where("mate is not null").withColumnRenamed("id", "row"), "row").join(mate, "mate")
    shared = written(met.mapInPandas(_align, "row long, marked boolean, place int, key long"), "shared-blocks")
    asked = written(shared.where("marked").groupBy("key").agg(F.count(F.lit(1)).alias("times")), "asked-blocks")
    every = found.select("host", F.explode(F.array_distinct("keys")).alias("key"))
    few = asked.count() <= BROADCAST_LOST
    hosts = (every.join(F.broadcast(asked), "key", "left_semi") if few else every).groupBy("key").agg(F.min("host").alias("a"), F.max("host").alias("b"))
    single = written(asked.join(hosts.where("a = b").select("key"), "key"), "template-keys")
    total = single.agg(F.sum("times")).first()[0] or 0
    own = met_by_key(shared.where("marked"), single, ["key"], "times", total)
    return own.select("row", "place").union(shared.where("not marked").select("row", "place"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, text (blocks joined by line feeds), n_lines, n_template (blocks that differencing deleted)."""
    lean(pages.sparkSession)

    kinds = {"id": pa.int64(), "url": pa.string(), "host": pa.string(), "path": pa.string(), "marked": pa.bool_(), "lines": pa.list_(pa.string()), "keys": pa.list_(pa.int64()), "sizes": pa.list_(pa.int32())}

    def read(batches):
        for batch in slices(batches, 256):
            found = [blocks(h) for h in batch.column("html").to_pylist()]
            lines = [i or e for i, e in found]
            where = [place(u) for u in batch.column("url").to_pylist()]
            made = [batch.column("id"), batch.column("url"), [h for h, _ in where], [p for _, p in where], [bool(i) for i, _ in found], lines, [line_keys(x) for x in lines], [[len(y) for y in x] for x in lines]]
            yield pa.RecordBatch.from_pydict({k: pa.array(c, t) if isinstance(c, list) else c for (k, t), c in zip(kinds.items(), made, strict=True)})

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    read_pages = rows.mapInArrow(read, "id long, url string, host string, path string, marked boolean, lines array<string>, keys array<long>, sizes array<int>")
    found = written(read_pages.withColumn("row", F.monotonically_increasing_id()), "page-blocks")
    lost = written(template_lines(found), "template-blocks")
    by_row = lost.groupBy("row").agg(F.sort_array(F.collect_set("place")).alias("lost"))
    met = found.select("row", "id", "url", "lines").join(F.broadcast(by_row) if lost.count() <= BROADCAST_LOST else by_row, "row", "left")
    kept = F.when(F.col("lost").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(without_spans(F.col("lines"), F.col("lost"), F.transform("lost", lambda x: x + 1)), "\n"))
    n_template = F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost"))
    return met.select(F.col("id").alias(id_col), F.col("url").alias(url_col), kept.alias("text"), F.size("lines").cast("long").alias("n_lines"), n_template.cast("long").alias("n_template"))
