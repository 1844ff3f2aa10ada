"""Interval algebra: overlaps, as-of shifts, solo regions, probe windows, reconciliation and merging of segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.functions.scalars import middle
from larkspan.operators.folds import Fold, fold


#: Cells of this many median lengths.
CELL_LENGTHS = 8.0
MOST_CELLS = 10_000


def _cell(left: DataFrame, right: DataFrame) -> float | None:
    lengths = left.select((F.col("end") - F.col("start")).alias("l")).union(right.select((F.col("end") - F.col("start")).alias("l")))
    median, longest = lengths.where("l > 0").agg(F.percentile_approx("l", 0.5), F.max("l")).first()
    return None if not median else max(median * CELL_LENGTHS, longest / MOST_CELLS)


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], cell: float | None = None) -> DataFrame:
    """All overlapping pairs of ``left`` and ``right`` (start, end) with equal ``keys``, cut to their overlap.

    Right columns other than the keys come as r_<name>. Both sides are dealt to cells of ``cell`` seconds, and a pair is made
    only in the first cell that both touch: a key with very many intervals spreads out. By default a cell is some median
    lengths wide, and the longest interval lies in ``MOST_CELLS`` of them at most.
    """
    cell = cell or _cell(left, right)
    renamed = right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys])
    if cell is None:
        pairs = left.join(renamed, keys)
    else:
        spread = lambda df, s, e: df.withColumn("__cell", F.explode(F.sequence(F.floor(F.col(s) / cell), F.floor(F.col(e) / cell))))
        pairs = spread(left, "start", "end").join(spread(renamed, "r_start", "r_end"), [*keys, "__cell"])
        pairs = pairs.where(F.col("__cell") == F.floor(F.greatest("start", "r_start") / cell)).drop("__cell")
    met = pairs.where((F.col("end") > F.col("r_start")) & (F.col("start") < F.col("r_end")))
    return met.withColumn("common_start", F.greatest("start", "r_start")).withColumn("common_end", F.least("end", "r_end"))


def offsets(segments: DataFrame, key: str = "id") -> DataFrame:
    """Per kept segment: its offset in the compressed time and the shift back to the original time."""
    before = Window.partitionBy(key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("end") - F.col("start")).over(before), F.lit(0.0))
    return segments.withColumn("offset", offset).withColumn("shift", F.col("start") - F.col("offset"))


def as_of(times: DataFrame, marks: DataFrame, key: str, at: str, mark: str, value: str) -> DataFrame:
    """``times`` with the value of the last mark at or before ``at``; the first mark's value before all marks."""
    rows = times.select(key, F.col(at).alias("__t"), F.lit(1).alias("__side"), F.struct(*times.columns).alias("__row"), F.lit(None).cast("double").alias("__v"))
    given = marks.select(key, F.col(mark).alias("__t"), F.lit(0).alias("__side"), F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"), F.col(value).cast("double").alias("__v"))
    past = Window.partitionBy(key).orderBy("__t", "__side")
    back = Window.partitionBy(key).orderBy("__t", "__side").rowsBetween(0, Window.unboundedFollowing)
    found = given.unionByName(rows).withColumn("__v", F.coalesce(F.last("__v", ignorenulls=True).over(past), F.first("__v", ignorenulls=True).over(back)))
    return found.where("__side = 1").select("__row.*", F.col("__v").alias(value))


def restore_time(segments: DataFrame, speech: DataFrame, key: str = "id") -> DataFrame:
    """Segments of a file without its pauses, in the file's own time, cut to the speech regions they touch."""
    marks = offsets(speech, key).groupBy(key, "offset").agg(F.max("shift").alias("shift"))  # regions of no length share an offset: the last stands
    placed = segments
    for end in ("start", "end"):  # each row carries its own shifts: a row number made twice need not be the same
        placed = as_of(placed, marks.withColumnRenamed("shift", f"__{end}"), key, end, "offset", f"__{end}")
    to = [F.col(end) + F.col(f"__{end}") for end in ("start", "end")]
    placed = placed.withColumns({"start": F.least(*to), "end": F.greatest(*to)}).drop("__start", "__end")
    cut = overlaps(placed, speech.select(key, "start", "end"), [key])
    return cut.select(*[c for c in placed.columns if c not in ("start", "end")], F.col("common_start").alias("start"), F.col("common_end").alias("end"))


def solo(segments: DataFrame, number: str, key: str = "id") -> DataFrame:
    """(key, number, start, end): the parts of each segment where no other one is; ``number``: unique whole numbers.

    A sweep over the ends: where one segment is open, the sum of open numbers is its own.
    """
    ends = segments.select(key, F.explode(F.array(*[F.struct(F.col(t).alias("t"), F.lit(d).alias("d"), (F.col(number) * d).alias("m")) for t, d in (("start", 1), ("end", -1))])).alias("e")).select(key, "e.*")
    at = ends.groupBy(key, "t").agg(F.sum("d").alias("d"), F.sum("m").alias("m"))
    sweep = Window.partitionBy(key).orderBy("t")
    open_ = at.select(key, F.col("t").alias("start"), F.lead("t").over(sweep).alias("end"), F.sum("d").over(sweep).alias("depth"), F.sum("m").over(sweep).alias(number))
    return open_.where("depth = 1 AND end > start").select(key, number, "start", "end")


def share_gap(gap: Column, both: Column, limit: float = 0.3) -> Column:
    """How far a side grows into a gap: half of it if both grow, else all, ``limit`` at most; negative gaps shrink."""
    return F.least(gap / F.when(both, 2).otherwise(1), F.lit(limit))


class _Reconcile(Fold):
    """Speaker and music rows by start. ``at`` is where the last row ended; a row waits until its successor is known."""

    def __init__(self, key: tuple, least: float, limit: float):
        self.key, self.least, self.limit = key, least, limit
        self.at, self.first, self.held = 0.0, True, None

    def row(self, r) -> list[tuple]:
        now = {"speaker": r.speaker, "start": float(r.start), "end": float(r.end), "music": bool(r.music), "duration": float(r.duration)}
        out = self._close(now)
        self.held = now
        return out

    def end(self) -> list[tuple]:
        return self._close(None)

    def _close(self, then: dict | None) -> list[tuple]:
        now, first = self.held, self.first
        if now is None:
            return []
        self.first = False
        if now["music"]:
            self.at = now["end"]
            return []
        if now["end"] < self.at or now["end"] - now["start"] < self.least:
            return []
        start, end = max(now["start"], self.at), now["end"]
        if first:
            start -= min(start - self.at, self.limit)
        if then is None:
            end += min(now["duration"] - end, self.limit)
        elif end <= then["start"]:
            grow = min((then["start"] - end) / (1 if then["music"] else 2), self.limit)
            end += grow
            if not then["music"]:
                then["start"] -= grow
            self.at = end
        else:
            self.at = end
            end = then["start"]
        return [(*self.key, now["speaker"], start, end)]


def reconcile(segments: DataFrame, key: str = "id", least: float = 0.2, limit: float = 0.3) -> DataFrame:
    """One speaker at a time: (key, speaker, start, end) of rows (key, speaker, start, end, music, duration, pos).

    Rows go by start; at equal starts speakers come before music, then by ``pos``. Overlapped regions belong to nobody;
    gaps are shared between neighbours; a result may be empty or negative where rows overlap twice.
    """
    kind = segments.schema[key].dataType.simpleString()
    return fold(segments, [key], ["start", "music", "pos"], lambda k: _Reconcile(k, least, limit), f"{key} {kind}, speaker string, start double, end double")


def whole_file(segments: DataFrame, key: str = "id") -> DataFrame:
    """For sources of one speaker a file: the first segment, stretched to the whole file."""
    first = segments.where("not music").groupBy(key).agg(F.min_by(F.struct("speaker", "duration"), "pos").alias("f"))
    return first.select(key, "f.speaker", F.lit(0.0).alias("start"), F.col("f.duration").alias("end"))


class _Merge(Fold):
    def __init__(self, key: tuple, gap: float, longest: float):
        self.key, self.gap, self.longest, self.held = key, gap, longest, None

    def row(self, r) -> list[tuple]:
        if self.held is not None:
            speaker, start, end = self.held
            if r.end - start <= self.longest and speaker == r.speaker and r.start - end < self.gap:
                self.held = (speaker, start, float(r.end))
                return []
        out = self.end()
        self.held = (r.speaker, float(r.start), float(r.end))
        return out

    def end(self) -> list[tuple]:
        return [] if self.held is None else [(*self.key, *self.held)]


def merge_neighbours(segments: DataFrame, key: str = "id", order: tuple[str, ...] = ("start", "end"), gap: float = 0.3, longest: float = 30.0) -> DataFrame:
    """Unite neighbours of one speaker that are less than ``gap`` apart, unless that is longer than ``longest``."""
    kind = segments.schema[key].dataType.simpleString()
    return fold(segments, [key], list(order), lambda k: _Merge(k, gap, longest), f"{key} {kind}, speaker string, start double, end double")


def chop(segments: DataFrame, piece: float = 20.0, longest: float = 28.0) -> DataFrame:
    """Cut pieces of ``piece`` seconds off while more than ``longest`` remain."""
    length = F.col("end") - F.col("start")
    full = F.when(length > longest, F.ceil((length - longest) / piece)).otherwise(F.lit(0)).cast("int")
    each = segments.withColumn("__full", full).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("__full"))))
    start = F.col("start") + F.col("piece") * piece
    return each.withColumn("end", F.when(F.col("piece") < F.col("__full"), start + piece).otherwise(F.col("end"))).withColumn("start", start).drop("__full")


def longest_middles(segments: DataFrame, group: list[str], seconds: float, most: int = 5) -> DataFrame:
    """The ``most`` longest segments of at least ``seconds`` in a group, each cut to its middle."""
    best = Window.partitionBy(*group).orderBy((F.col("end") - F.col("start")).desc(), "start")
    chosen = segments.where(F.col("end") - F.col("start") >= seconds).withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= most)
    m = middle(F.col("start"), F.col("end"), seconds)
    return chosen.withColumn("__m", m).withColumn("start", F.col("__m.start")).withColumn("end", F.col("__m.end")).drop("__m")


def longest_middles_with_fallback(segments: DataFrame, group: list[str], lengths: tuple[float, ...] = (5.0, 3.0, 1.0), most: int = 5) -> DataFrame:
    """As ``longest_middles``, with the first of ``lengths`` that a group has any segment for."""
    longest = segments.groupBy(*group).agg(F.max(F.col("end") - F.col("start")).alias("__longest"))
    wanted = F.coalesce(*[F.when(F.col("__longest") >= x, F.lit(x)) for x in lengths])
    rows = segments.join(longest.withColumn("__want", wanted).drop("__longest"), group)
    best = Window.partitionBy(*group).orderBy((F.col("end") - F.col("start")).desc(), "start")
    chosen = rows.where(F.col("end") - F.col("start") >= F.col("__want")).withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= most)
    half, centre = F.col("__want") / 2, (F.col("start") + F.col("end")) / 2
    longer = F.col("end") - F.col("start") > F.col("__want")
    return chosen.withColumn("__s", F.when(longer, centre - half).otherwise(F.col("start"))).withColumn("end", F.when(longer, centre + half).otherwise(F.col("end"))).withColumn("start", F.col("__s")).drop("__s", "__want")


def probe_windows(segments: DataFrame, targets: DataFrame, length: float, key: str = "id") -> DataFrame:
    """For each target time (key, at): the first segment of at least ``length`` that begins at or after it, whose first part
    it is, or that ends no earlier than the target plus ``length``, whose last part it is."""
    begins, reaches = F.col("start") >= F.col("at"), F.col("end") >= F.col("at") + length
    room = targets.join(segments, key).where((F.col("end") - F.col("start") >= length) & (begins | reaches))
    first = Window.partitionBy(key, "at").orderBy("start", "end")
    begin = F.when(begins, F.col("start")).otherwise(F.col("end") - length)
    return room.withColumn("__turn", F.row_number().over(first)).where("__turn = 1").select(key, "at", begin.alias("start"), (begin + length).alias("end"))


def spread_probes(segments: DataFrame, key: str = "id", count: int = 5, lengths: tuple[float, ...] = (5.0, 3.0, 1.0)) -> DataFrame:
    """``count`` windows of a file, spread over its speech, without near repeats, of the first length that gives more than
    one (else of the last)."""
    total = segments.groupBy(key).agg((F.sum(F.col("end") - F.col("start")) / count + 1).alias("__step"))
    targets = total.select(key, F.explode(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: i * F.col("__step"))).alias("at"))
    found = None
    for turn, length in enumerate(lengths):
        own = probe_windows(segments, targets, length, key).withColumn("__near", F.round("start", 6)).dropDuplicates([key, "__near"]).drop("__near", "at").withColumn("length", F.lit(length)).withColumn("__turn", F.lit(turn))
        found = own if found is None else found.unionByName(own)
    counted = found.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(key, "__turn")))
    good = F.when((F.col("__n") > 1) | (F.col("__turn") == len(lengths) - 1), F.col("__turn"))
    return counted.withColumn("__best", F.min(good).over(Window.partitionBy(key))).where("__turn = __best").drop("__turn", "__n", "__best")


def least_length(duration: Column) -> Column:
    """Segments for embeddings: of 1 s in files under 30 s, else of 3 s."""
    return F.when(duration < 30, 1.0).otherwise(3.0)
