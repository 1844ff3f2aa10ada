"""Registered queries: each applies operators of the library to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.functions import scalars
from larkspan.operators import augment, graph, intervals, ml, reports, selection, similarity, udf_slots, votes
from larkspan.plans.relations import files, language_rows, segments, speakers, table
from larkspan.sinks import artifacts
from larkspan.sinks import tables as keyed
from larkspan.sources import parsers
from larkspan.sources import tables as scans

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


BOTH = "duration + duration_non_lt"


@query
def global_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.totals(speakers(spark, sf_dir), F.expr(BOTH))


@query
def lt_totals(spark, sf_dir):
    return reports.positive_totals(speakers(spark, sf_dir), "duration")


@query
def non_lt_totals(spark, sf_dir):
    return reports.positive_totals(speakers(spark, sf_dir), "duration_non_lt")


@query
def top_speakers_lt(spark, sf_dir):
    return reports.top_sums(speakers(spark, sf_dir), "sp", "duration", 50)


@query
def top_speakers_non_lt(spark, sf_dir):
    return reports.top_sums(speakers(spark, sf_dir), "sp", "duration_non_lt", 10)


@query
def cap_sweep(spark, sf_dir):
    return reports.cap_sweep(speakers(spark, sf_dir), F.col("duration"), reports.CAPS_HOURS)


@query
def file_scan(spark, sf_dir):
    """All files in path order."""
    return scans.scan_files(files(spark, sf_dir)).select("id", "path", "duration_in_sec", "source")


@query
def sources_scan(spark, sf_dir):
    return scans.files_of(files(spark, sf_dir), ["src0", "src1"]).select("id", "path")


@query
def speaker_durations(spark, sf_dir):
    found = reports.speaker_durations(segments(spark, sf_dir), ["id", "speaker"])
    return found.withColumn("duration_in_sec", F.round("duration_in_sec", 3))


@query
def speaker_split_durations(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    rows = d.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id").select(F.col("doc_id").alias("file_id"), F.lit("S").alias("speaker"), F.col("n_chars").alias("duration_in_sec"), F.rpad("lang", 3, " ").alias("language"))
    return reports.split_durations(d.select(F.col("source").alias("cluster"), F.col("doc_id").alias("f"), F.lit("S").alias("sp")), rows, own="en")


def gendered(spark, sf_dir) -> DataFrame:
    d, q = table(spark, sf_dir, "documents"), F.col("quality")
    g = F.when(q == 1, "m").when(q == 0, "f").otherwise("-")
    return d.join(table(spark, sf_dir, "labels"), "doc_id", "left").select("source", "doc_id", F.col("lang").alias("gs"), g.alias("gender"), F.lit(0.0).alias("start"), F.col("n_chars").cast("double").alias("end"))


@query
def source_gender_stats(spark, sf_dir):
    return reports.source_gender_stats(gendered(spark, sf_dir)).withColumn("level", F.col("level").cast("long"))


@query
def grand_totals(spark, sf_dir):
    return reports.grand_totals(reports.source_gender_stats(gendered(spark, sf_dir)))


def final_segments(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    source = F.when(kind == "view", "crawl").when(kind == "click", "liepa3-speaker").otherwise(kind)
    gender = F.when(kind == "error", "").when(F.col("user_id") < 75, "m").otherwise("f")
    return e.select("event_id", F.col("user_id").cast("string").alias("gs"), kind.alias("id"), source.alias("source"), gender.alias("gender"), F.lit("lt").alias("lang"), F.lit(0.0).alias("start"), F.col("value").alias("end"))


@query
def eligible_segments(spark, sf_dir):
    return selection.eligible(final_segments(spark, sf_dir)).select("event_id", "source", "gs", "gender")


@query
def greedy_selection(spark, sf_dir):
    chosen = selection.select_budget(final_segments(spark, sf_dir), take=400.0, male=60.0, female=90.0, number="event_id")
    return chosen.select("event_id", "gs", "source")


@query
def size_histogram(spark, sf_dir):
    return reports.histogram(table(spark, sf_dir, "documents"), "n_chars", 10).withColumn("low", F.round("low", 6))


@query
def gender_vote(spark, sf_dir):
    return votes.gender_vote(gendered(spark, sf_dir), ["source"], "gender")


@query
def language_decision(spark, sf_dir):
    return language_rows(spark, sf_dir).select("grp", votes.language_decision(F.col("found"), own="en").alias("language"))


@query
def first_n_per_run(spark, sf_dir):
    return selection.first_of_runs(files(spark, sf_dir), 2).select("path", "folder", "run", "turn")


@query
def folder_islands(spark, sf_dir):
    return selection.folder_clusters(files(spark, sf_dir)).select("run", "folder", F.size("members").cast("long").alias("n"), F.col("members")[0]["f"].alias("first"))


@query
def middle_top5(spark, sf_dir):
    found = intervals.longest_middles(segments(spark, sf_dir), ["id", "speaker"], 5.0)
    return found.select("event_id", F.col("turn").cast("long").alias("turn"), F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


@query
def chop_pieces(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.lit(0.0).alias("start"), (F.col("n_chars") / 10.0).alias("end"))
    return intervals.chop(d).select("doc_id", F.col("piece").cast("long").alias("piece"), F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query
def budget_cutoff(spark, sf_dir):
    order = [selection.shuffled("42", "doc_id"), "doc_id"]
    return selection.until_budget(files(spark, sf_dir), ["source"], order, F.col("duration_in_sec"), 20000.0).select("source", "doc_id", "before")


def packable(spark, sf_dir) -> DataFrame:
    return files(spark, sf_dir).select("source", F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.lit(0).cast("long").alias("pos"), F.lit(0.0).alias("start"), F.col("duration_in_sec").alias("end"))


@query
def next_fit_chunks(spark, sf_dir):
    return selection.next_fit(packable(spark, sf_dir), 6000.0).select("source", "path", "chunk")


@query
def tar_assignment(spark, sf_dir):
    return selection.tars(selection.next_fit(packable(spark, sf_dir), 6000.0), 5).groupBy("source", "tar").agg(F.count_distinct("chunk").alias("chunks"), F.sum("end").alias("seconds"))


@query
def split_95(spark, sf_dir):
    return selection.split(files(spark, sf_dir), "path").groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("duration_in_sec").alias("seconds"))


@query
def interval_overlap(spark, sf_dir):
    s = segments(spark, sf_dir)
    met = intervals.overlaps(s.where("speaker = 'click'"), s.where("speaker = 'view'").drop("speaker"), ["id"])
    return met.select("event_id", "r_event_id", F.round("common_start", 3).alias("low"), F.round("common_end", 3).alias("high"))


@query
def asof_shift(spark, sf_dir):
    s = segments(spark, sf_dir)
    marks = s.where("speaker = 'view'").select("id", F.col("start").alias("mark"), (F.col("end") - F.col("start")).alias("shift"))
    found = intervals.as_of(s.where("speaker <> 'view'").select("id", "event_id", "start"), marks, "id", "start", "mark", "shift")
    return found.select("event_id", F.round("shift", 3).alias("shift"))


@query
def speech_offsets(spark, sf_dir):
    found = intervals.offsets(segments(spark, sf_dir).where("speaker = 'view'"))
    return found.select("event_id", F.round("offset", 3).alias("offset"))


@query
def solo_speech(spark, sf_dir):
    found = intervals.solo(segments(spark, sf_dir), "event_id")
    return found.select("event_id", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


@query
def w5_merge_segments(spark, sf_dir):
    merged = intervals.merge_neighbours(segments(spark, sf_dir), order=("start", "event_id"), gap=0.3, longest=300.0)
    return merged.select("id", "speaker", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


@query
def reconciled_segments(spark, sf_dir):
    s = segments(spark, sf_dir)
    ends = s.groupBy("id").agg(F.max("end").alias("duration"))
    rows = s.join(ends, "id").select("id", "speaker", "start", "end", (F.col("speaker") == "view").alias("music"), "duration", F.col("event_id").alias("pos"))
    found = intervals.reconcile(rows).where("end - start >= 0.2")
    return found.withColumn("start", F.round("start", 3)).withColumn("end", F.round("end", 3))


@query
def probe_windows(spark, sf_dir):
    """Probes by the time since a user's first segment."""
    s = segments(spark, sf_dir)
    low = s.groupBy("id").agg(F.min("start").alias("low"))
    own = s.join(low, "id").select("id", (F.col("start") - F.col("low")).alias("start"), (F.col("end") - F.col("low")).alias("end"))
    return intervals.spread_probes(own).select("id", "length", F.round("start", 3).alias("start"))


@query
def restored_time(spark, sf_dir):
    s = segments(spark, sf_dir)
    speech = s.where("speaker = 'view'").select("id", "start", "end")
    low = s.groupBy("id").agg(F.min("start").alias("low"))
    spoken = s.where("speaker = 'click'").join(low, "id").select("id", "event_id", (F.col("start") - F.col("low")).alias("start"), (F.col("end") - F.col("low")).alias("end"))
    found = intervals.restore_time(spoken, speech)
    return found.withColumn("start", scalars.rounded(F.col("start"), 3)).withColumn("end", scalars.rounded(F.col("end"), 3))


def vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("emb"))


def near_edges(spark, sf_dir) -> DataFrame:
    return similarity.edges(similarity.knn(vectors(spark, sf_dir), k=50, least=0.3, lists=1))  # exact at every size, as the SQL is


@query
def knn_edges(spark, sf_dir):
    return near_edges(spark, sf_dir).withColumn("w", F.round("w", 3))


@query
def components(spark, sf_dir):
    return graph.components(vectors(spark, sf_dir).select(F.col("id").alias("node")), near_edges(spark, sf_dir))


@query
def cluster_sizes(spark, sf_dir):
    return reports.cluster_sizes(components(spark, sf_dir), "component")


@query
def communities(spark, sf_dir):
    return graph.communities(vectors(spark, sf_dir).select(F.col("id").alias("node")), near_edges(spark, sf_dir))


@query
def mean_norm(spark, sf_dir):
    return vectors(spark, sf_dir).agg(F.round(F.avg(scalars.norm(F.col("emb"))), 4).alias("mean_norm"))


@query
def rttm_roundtrip(spark, sf_dir):
    text = artifacts.rttm_text(segments(spark, sf_dir).withColumn("start", F.round("start", 3)).withColumn("end", F.round("end", 3)))
    return parsers.parse_rttm(text, F.col("content"), uri="waveform").select("id", "speaker", F.round("start", 2).alias("start"))


@query
def ina_parse(spark, sf_dir):
    line = F.concat(F.lit('["'), "speaker", F.lit('", '), F.col("event_id").cast("string"), F.lit(", "), (F.col("event_id") + 0.5).cast("string"), F.lit("]"))
    text = segments(spark, sf_dir).groupBy("id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", line.alias("line")))), lambda x: x["line"]), "").alias("content"))
    return parsers.parse_segments(text, F.col("content")).select("id", "label", "start", "end")


@query
def vad_to_rttm(spark, sf_dir):
    line = F.concat(F.lit('{"from": '), F.col("event_id").cast("string"), F.lit(', "to": '), (F.col("event_id") + 1).cast("string"), F.lit("}"))
    text = segments(spark, sf_dir).groupBy("id").agg(F.concat(F.lit("["), F.array_join(F.collect_list(line), ","), F.lit("]")).alias("content"))
    found = artifacts.vad_to_rttm(parsers.parse_vad(text, F.col("content")))
    return found.select("id", F.length("content").cast("long").alias("n_chars"), F.md5("content").alias("digest"))


def labelled(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language"), "source", F.col("n_chars").alias("n"))
    return d, table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("language"))


@query
def upsert_merge(spark, sf_dir):
    d, new = labelled(spark, sf_dir)
    return keyed.merge_columns(d, new, ["doc_id"], ["language"])


@query
def upsert_blobs(spark, sf_dir):
    d, new = labelled(spark, sf_dir)
    return keyed.upsert(d, new.withColumn("source", F.lit("new")).withColumn("n", F.lit(0).cast("long")), ["doc_id"], keep=["n"])


@query
def insert_if_absent(spark, sf_dir):
    d, new = labelled(spark, sf_dir)
    return keyed.insert_if_absent(new, d.select("doc_id", "language"), ["doc_id"])


@query
def update_by_key(spark, sf_dir):
    d, new = labelled(spark, sf_dir)
    return keyed.update_columns(d, new, ["doc_id"], ["language"])


@query
def move_source(spark, sf_dir):
    chosen = selection.first_of_runs(files(spark, sf_dir), 1).select("id")
    return keyed.move_source(files(spark, sf_dir).select("id", "path", "source"), chosen, "moved")


@query
def resume_pending(spark, sf_dir):
    f = files(spark, sf_dir)
    kv = table(spark, sf_dir, "labels").select(scalars.file_id(F.col("doc_id").cast("string")).alias("id"), F.lit("audio.rttm").alias("type"))
    return udf_slots.pending(f, kv, "audio.rttm").select("id", "path")


@query
def collect_jsonl(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    line = F.to_json(F.struct("turn", "role"))
    kv = c.groupBy(F.col("conv_id").cast("string").alias("id")).agg(F.encode(F.concat(F.array_join(F.collect_list(line), "\n"), F.lit("\n\n")), "UTF-8").alias("content")).withColumn("type", F.lit("turns.jsonl"))
    return artifacts.collect_jsonl(kv.select("id"), kv, "turns.jsonl", "turn long, role string")[0]


@query
def kv_pivot(spark, sf_dir):
    """Blobs of two types in one row per file, with the file's columns where there are any."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    q = table(spark, sf_dir, "labels")
    kv = q.select("doc_id", F.lit("quality").alias("type"), F.col("quality").alias("v")).union(q.select("doc_id", F.lit("toxic").alias("type"), F.col("toxic").alias("v")))
    wide = scans.of_types(kv, "quality", "toxic").groupBy("doc_id").agg(*[F.max(F.when(F.col("type") == t, F.col("v"))).alias(t) for t in ("quality", "toxic")])
    return wide.join(d, "doc_id", "left")


@query
def aug_plan(spark, sf_dir):
    choices = {"rir": ["r0", "r1", "r2"], "noise": ["n0", "n1"], "codec": ["mp3", "ogg", "none", "none"]}
    return augment.plan(files(spark, sf_dir).select("path"), choices).select("path", F.col("variant").cast("long").alias("variant"), "name", "rir", "noise", "codec")


@query
def tar_complete(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.lit("tar_file").alias("type"), F.col("o_orderkey").alias("tar"))
    lines = table(spark, sf_dir, "lineitem").select(F.lit("file_done").alias("type"), F.col("l_orderkey").alias("tar"))
    return augment.completeness(orders.union(lines))


@query
def label_sums(spark, sf_dir):
    s = segments(spark, sf_dir).withColumnRenamed("speaker", "label")
    found = reports.label_sums(s, ("view", "click", "error"), "id")
    return found.select("id", *[F.round(c, 3).alias(c) for c in ("view", "click", "error")])


@query
def corpus_totals(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select((F.col("lang") != "de").alias("ok"), F.col("n_chars").alias("result"))
    return reports.total_of_results(d)


@query
def moving_average(spark, sf_dir):
    found = selection.moving_average(table(spark, sf_dir, "orders"), "o_orderkey", ["o_orderkey"], ["o_custkey"])
    return found.select("o_orderkey", F.round("moving", 6).alias("moving"))


@query
def cluster_disagreement(spark, sf_dir):
    return votes.disagreement(gendered(spark, sf_dir).withColumnRenamed("gender", "g"), "source", "g")


@query
def scalar_functions(spark, sf_dir):
    f = files(spark, sf_dir)
    return f.select("doc_id", scalars.duration_text(F.col("duration_in_sec") * 10).alias("took"), scalars.dirname(F.col("path")).alias("folder"), scalars.basename(F.col("path")).alias("name"), scalars.six_digits(F.col("doc_id")).alias("shard"), scalars.cluster_name(F.col("path")).alias("cluster"), scalars.without_prefix(F.col("path"), "src").alias("below"))


@query
def mapped_results(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    found = udf_slots.map_function(texts, lambda: lambda t: str((t or "").count("\n")).encode(), "text")
    return found.select("id", "status", F.decode("result", "UTF-8").cast("long").alias("breaks"))


@query
def gender_model(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("emb"), F.when(F.col("label") % 2 == 0, "m").otherwise("f").alias("g"))
    return ml.predict_gender(ml.train_gender(v), v).select("vec_id", "g", "p")


@query
def kmeans_units(spark, sf_dir):
    v = vectors(spark, sf_dir)
    return ml.units(ml.train_units(v, k=16), v).select("id", "unit")


@query
def training_balance(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    members = d.select(F.col("source").alias("cluster"), F.col("doc_id").alias("f"), F.col("lang").alias("sp"), F.col("doc_id").alias("pos"))
    labels = gendered(spark, sf_dir).select(F.col("doc_id").alias("f"), F.col("gs").alias("sp"), F.col("gender").alias("label")).where("label <> '-'")
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("f"), F.col("embedding").alias("emb"))
    return ml.balance(ml.training_set(members, labels, emb.join(d.select(F.col("doc_id").alias("f"), F.col("lang").alias("sp")), "f")))


# Extensions: categories that need no operator of ours.


@query
def ext_cube(spark, sf_dir):
    return table(spark, sf_dir, "documents").cube("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query
def ext_set_operations(spark, sf_dir):
    d, q = (table(spark, sf_dir, t).select("doc_id") for t in ("documents", "labels"))
    tagged = lambda df, t: df.withColumn("kind", F.lit(t))
    return tagged(d.intersect(q), "both").union(tagged(d.exceptAll(q), "unlabelled"))


@query
def ext_hourly_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return e.groupBy(F.window("at", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.unix_seconds("w.start").alias("hour"), "event_type", "n")


@query
def ext_star_join(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))

