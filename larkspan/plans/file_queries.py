"""Registered queries whose data pass through files, blobs, archives, processes and streams, and their SQL."""

from __future__ import annotations

import sys
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan import schemas
from larkspan.functions import scalars
from larkspan.operators import audio, augment, graph, ml, ordered, reports, selection, udf_slots
from larkspan.plans import entrypoints
from larkspan.plans.queries import near_edges, packable, vectors
from larkspan.plans.relations import FILES, SEGMENTS, files, segments, table
from larkspan.sinks import archives, artifacts
from larkspan.sinks import tables as keyed
from larkspan.sources import parsers
from larkspan.sources import tables as scans
from larkspan.storage import shared_dir, written
from larkspan.streaming import completeness

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


def folder_of(spark: SparkSession, name: str) -> str:
    """A folder of its own for each run, in the shared folder."""
    return f"{shared_dir(spark)}/larkspan/{name}-{uuid.uuid4().hex}"


def text_file(df: DataFrame, name: str) -> str:
    folder = folder_of(df.sparkSession, name)
    df.select("line").write.text(folder)
    return folder


def rttm_blobs(spark, sf_dir) -> DataFrame:
    """kv rows with a user's segments as RTTM."""
    return artifacts.rttm_text(segments(spark, sf_dir)).select("id", F.lit("audio.rttm").alias("type"), F.encode("content", "UTF-8").alias("content"), F.lit(None).cast("timestamp").alias("created_at"))


def text_blobs(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("octet_length(text) > 0")
    kind = F.when(F.col("doc_id") % 2 == 0, "page.TXT").otherwise("page.md")
    return d.select(scalars.file_id(F.col("doc_id").cast("string")).alias("id"), kind.alias("type"), F.encode("text", "UTF-8").alias("content"))


# Scans.


@query("SELECT md5(CAST(d.doc_id AS VARCHAR)) AS id, CAST(quality AS VARCHAR) AS content, l.doc_id IS NOT NULL AS found FROM documents d LEFT JOIN labels l USING (doc_id)")
def blobs_found(spark, sf_dir):
    """Blobs by key, and the keys that have none."""
    kv = table(spark, sf_dir, "labels").select(scalars.file_id(F.col("doc_id").cast("string")).alias("id"), F.lit("q").alias("type"), F.col("quality").cast("string").alias("content"))
    hit, miss = scans.load_blobs(files(spark, sf_dir).select("id", F.lit("q").alias("type")), kv)
    return hit.select("id", "content", F.lit(True).alias("found")).unionByName(miss.select("id", F.lit(None).cast("string").alias("content"), F.lit(False).alias("found")))


@query(f"WITH f AS ({FILES}) SELECT id, path FROM f WHERE source = 'src0'")
def files_of_source(spark, sf_dir):
    """S3 and P1 with the pushed filter."""
    return scans.scan_files(files(spark, sf_dir), "src0").select("id", "path")


@query("SELECT md5(CAST(doc_id AS VARCHAR)) || '/' || CASE WHEN doc_id % 2 = 0 THEN 'page.TXT' ELSE 'page.md' END AS name, octet_length(encode(text))::BIGINT AS n_bytes FROM documents WHERE length(text) > 0 AND doc_id % 2 = 0")
def walked_files(spark, sf_dir):
    """Files below a folder by extension, in any case; K18 writes them."""
    folder = folder_of(spark, "walked")
    archives.export_artifacts(text_blobs(spark, sf_dir), folder).count()
    return scans.walk(spark, folder, ["txt"]).select(F.regexp_extract("path", "([^/]*/[^/]*)$", 1).alias("name"), F.col("length").alias("n_bytes"))


@query("SELECT md5(CAST(doc_id AS VARCHAR)) AS id, CASE WHEN doc_id % 2 = 0 THEN 'page.TXT' ELSE 'page.md' END AS type, md5(text) AS digest FROM documents WHERE length(text) > 0")
def exported_blobs(spark, sf_dir):
    """Blobs to files and back."""
    folder = folder_of(spark, "exported")
    archives.export_artifacts(text_blobs(spark, sf_dir), folder).count()
    return scans.read_blobs(spark, folder, ["page.TXT", "page.md"]).select("id", "type", F.md5("content").alias("digest"))


@query("SELECT md5('x/' || md5(CAST(doc_id AS VARCHAR)) || '/page.md') AS id, 'x/' || md5(CAST(doc_id AS VARCHAR)) || '/page.md' AS path, 'here' AS source FROM documents WHERE length(text) > 0 AND doc_id % 2 = 1")
def indexed_files(spark, sf_dir):
    """Files of an exact name become rows of the files table."""
    folder = folder_of(spark, "indexed")
    archives.export_artifacts(text_blobs(spark, sf_dir), folder).count()
    found = scans.walk(spark, folder, names=[" page.md ", ""])
    return scans.index_files(found, folder.removeprefix("file://"), "here", "x/").select("id", "path", "source")


@query("SELECT user_id::VARCHAR AS id, event_type AS speaker, round(epoch_us(ts) / 1e9, 3) AS start, round(value, 2) AS length FROM events")
def jsonl_roundtrip(spark, sf_dir):
    """JSON lines with rounded times, read by schema and through SQL."""
    folder = folder_of(spark, "jsonl")
    artifacts.write_jsonl(segments(spark, sf_dir).select("id", "speaker", "start", "end"), folder, ["start", "end"])
    parsers.read_jsonl(spark, folder, "id string, speaker string, start double, end double").createOrReplaceTempView("larkspan_lines")
    return spark.sql("SELECT id, speaker, start, round(end - start, 2) AS length FROM larkspan_lines")


@query("SELECT role AS sp, CAST(turn AS VARCHAR) AS f, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos FROM conversations")
def cluster_lines(spark, sf_dir):
    """An array of members on each line."""
    member = F.struct("turn", F.struct(F.col("role").alias("sp"), F.col("turn").cast("string").alias("f")).alias("m"))
    lines = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.transform(F.sort_array(F.collect_list(member)), lambda x: x["m"])).alias("line"))
    return parsers.read_clusters(spark, text_file(lines, "clusters")).select("sp", "f", F.col("pos").cast("long").alias("pos"))


@query("SELECT r_regionkey AS k, r_name AS name FROM region")
def json_document(spark, sf_dir):
    """One document in a file."""
    whole = table(spark, sf_dir, "region").agg(F.to_json(F.collect_list(F.struct(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")))).alias("line"))
    pretty = whole.select(F.regexp_replace("line", "([{,])", "$1\n").alias("line")).coalesce(1)
    return parsers.read_document(spark, text_file(pretty, "document"), "k long, name string")


@query("SELECT doc_id, source FROM documents")
def lines_with_path(spark, sf_dir):
    """Lines of many files, with each file's path."""
    folder = folder_of(spark, "by-path")
    table(spark, sf_dir, "documents").select("doc_id", "source").write.partitionBy("source").json(folder)
    found = parsers.jsonl_with_path(spark, folder, "*.json", "doc_id long")
    return found.select("doc_id", F.regexp_extract("f", "source=([^/]+)/", 1).alias("source"))


@query("WITH w AS (SELECT 'w' || n_nationkey AS name, CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey / 2.0::DOUBLE END AS value FROM nation) FROM w UNION ALL SELECT 'none', 0.0 FROM w")
def lookup_words(spark, sf_dir):
    """S28's lists of names with and without values, and as many choices of nothing."""
    n = F.col("n_nationkey")
    lines = table(spark, sf_dir, "nation").select(F.concat_ws("  ", F.concat(F.lit("w"), n.cast("string")), F.when(n % 3 > 0, (n / 2.0).cast("string"))).alias("line"))
    return parsers.with_absent(parsers.read_words(spark, text_file(lines, "words")))


@query("SELECT CAST(vec_id // 10 AS VARCHAR) AS id, 'S' || (vec_id % 3) AS sp, CAST(max(vec_id) AS DOUBLE) AS first FROM embeddings GROUP BY ALL")
def embedding_lines(spark, sf_dir):
    """The last line of a speaker counts."""
    v = F.col("vec_id")
    line = F.to_json(F.struct(F.concat(F.lit("S"), (v % 3).cast("string")).alias("sp"), F.array(v).alias("emb")))
    text = table(spark, sf_dir, "embeddings").groupBy(F.floor(v / 10).cast("string").alias("id")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("vec_id", line.alias("line")))), lambda x: x["line"]), "\n").alias("content"))
    return parsers.parse_embeddings(text, F.col("content")).select("id", "sp", F.col("emb")[0].cast("double").alias("first"))


@query("SELECT CAST(conv_id AS VARCHAR) AS id, role AS speaker, 'lt' AS lang, turn / 2.0::DOUBLE AS conf FROM conversations")
def language_lines(spark, sf_dir):
    """Languages of speakers."""
    segment = F.struct(F.lit(0.0).alias("start"), F.lit(1.0).alias("end"))
    line = F.to_json(F.struct(F.col("role").alias("speaker"), F.array(F.struct(segment.alias("segment"), F.lit("lt").alias("lang"), (F.col("turn") / 2.0).alias("conf"))).alias("lang_res")))
    text = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("string").alias("id")).agg(F.array_join(F.collect_list(line), "\n").alias("content"))
    return parsers.parse_languages(text, F.col("content")).select("id", "speaker", F.inline("lang_res")).select("id", "speaker", "lang", "conf")


# Waves.


def wave(samples: Column, rate: int = 16000) -> Column:
    """Mono wave data of 16 bits with so many samples of the value 1."""
    little = lambda n, size: F.concat(*[F.substring(F.lpad(F.hex(n), 2 * size, "0"), 2 * (size - i) - 1, 2) for i in range(size)])
    head = [F.lit("52494646"), little(samples * 2 + 36, 4), F.lit("57415645666D74201000000001000100"), little(F.lit(rate), 4), little(F.lit(2 * rate), 4), F.lit("0200100064617461"), little(samples * 2, 4)]
    return F.unhex(F.concat(*head, F.repeat(F.lit("0100"), samples.cast("int"))))


@query("SELECT doc_id, round((n_chars % 5000) / 16000, 6) AS seconds FROM documents")
def wave_lengths(spark, sf_dir):
    """Seconds by the header."""
    d = table(spark, sf_dir, "documents").select("doc_id", wave(F.col("n_chars") % 5000).alias("content"))
    seconds = F.when(F.col("content").isNotNull(), audio.wave_duration(F.col("content")))
    return d.select("doc_id", scalars.rounded(seconds, 6).alias("seconds"))


@query("SELECT doc_id % 7 AS grp, CAST(sum(500) AS BIGINT) AS samples FROM documents GROUP BY ALL")
def wave_cuts(spark, sf_dir):
    """Two ranges of each wave, end to end, and the waves of a group joined."""
    d = table(spark, sf_dir, "documents").select("doc_id", wave(F.col("n_chars") % 1000 + 4000).alias("content"))
    ranges = d.select("doc_id", F.explode(F.array(*[F.struct(F.lit(a).alias("start"), F.lit(a + 1 / 64).alias("end")) for a in (1 / 8, 0.0)])).alias("r")).select("doc_id", "r.*")
    parts = audio.cut_files(d, ranges, "doc_id").withColumn("grp", F.col("doc_id") % 7)
    whole = audio.concat_files(parts, "grp", ["doc_id"])
    return whole.select("grp", F.round(audio.wave_duration(F.col("audio")) * 16000).cast("long").alias("samples"))


# Archives and text artifacts.


@query("SELECT source, doc_id || '.wav' AS member, md5(text) AS digest FROM documents WHERE length(text) > 0")
def tars_roundtrip(spark, sf_dir):
    """Tars by source, and their members."""
    folder = folder_of(spark, "tars")
    members = table(spark, sf_dir, "documents").select("source", F.concat(F.col("doc_id").cast("string"), F.lit(".wav")).alias("member"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))
    archives.write_tars(members, ["source"], folder).count()
    tars = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(folder)
    return archives.read_tars(tars).select(F.regexp_extract("path", r"([^/]*)\.tar$", 1).alias("source"), "member", F.md5("data").alias("digest"))


@query("SELECT source, count(*) AS members FROM documents GROUP BY source")
def zips_written(spark, sf_dir):
    """A zip for each source."""
    members = table(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("member"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))
    found = archives.write_zips(members, ["source"], folder_of(spark, "zips"))
    return found.select(F.regexp_extract("archive", r"([^/]*)\.zip$", 1).alias("source"), "members")


@query("WITH t AS (SELECT 'src' || (n_nationkey % 2) || '/' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') || '.tar' AS path, n_nationkey AS n FROM nation) SELECT path FROM t WHERE n >= 5 AND n < 20")
def shards_in_range(spark, sf_dir):
    """Shards by the numbers in their names."""
    n = F.col("n_nationkey")
    return scans.key_range(table(spark, sf_dir, "nation").select(F.concat(F.lit("src"), (n % 2).cast("string"), F.lit("/"), scalars.six_digits(n), F.lit(".tar")).alias("path")), 5, 20)


@query(f"WITH f AS ({FILES}) SELECT path || chr(9) || CAST(doc_id * 16 AS VARCHAR) AS line FROM f UNION ALL SELECT '/data'")
def manifest_lines(spark, sf_dir):
    """Paths and samples below a root."""
    return artifacts.manifest(files(spark, sf_dir).select("path", (F.col("doc_id") * 16).alias("nsamples")), "/data")


@query("SELECT n_name || ' /data/' || n_nationkey AS line FROM nation UNION ALL SELECT range || ' 1' FROM range(100)")
def list_lines(spark, sf_dir):
    """Lists of names and paths, and a dictionary of units."""
    named = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.concat(F.lit("/data/"), F.col("n_nationkey").cast("string")).alias("path"))
    return artifacts.scp(named).unionByName(artifacts.unit_dictionary(spark, 100))


@query("SELECT CAST(user_id AS VARCHAR) AS id, count(DISTINCT event_type) + 1 AS tiers, 2 * count(*) AS intervals FROM events GROUP BY user_id")
def textgrid_tiers(spark, sf_dir):
    """A tier for each speaker and one of marks."""
    s = segments(spark, sf_dir)
    grid = artifacts.textgrid(s, s.select("id", F.lit("speech").alias("label"), "start", "end"))
    matches = lambda pattern: F.size(F.regexp_extract_all("content", F.lit(pattern), F.lit(0))).cast("long")
    return grid.select("id", matches('class = "IntervalTier"').alias("tiers"), matches(r"intervals \[\d+\]:").alias("intervals"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def snapshot_restored(spark, sf_dir):
    """Copies of tables, read again."""
    folder = folder_of(spark, "snapshot")
    keyed.snapshot({"nation": table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")}, folder)
    return keyed.restore(spark, folder, ["nation"])["nation"]


@query("SELECT r_regionkey AS rank, doc_id FROM documents, region WHERE doc_id % 5 = r_regionkey AND r_regionkey < 3")
def joined_shards(spark, sf_dir):
    """Lines of shards one after the other."""
    d = table(spark, sf_dir, "documents")
    return keyed.union_shards([d.where(F.col("doc_id") % 5 == i).select("doc_id") for i in range(3)], "doc_id").select(F.col("rank").cast("long").alias("rank"), "doc_id")


@query("SELECT doc_id FROM labels")
def found_or_error(spark, sf_dir):
    """Keys that must be known."""
    return keyed.assert_all_found(table(spark, sf_dir, "labels").select("doc_id"), table(spark, sf_dir, "documents"), ["doc_id"], "document")


@query("SELECT r_regionkey AS name, r_regionkey * 10 AS delay FROM region")
def rirs_with_delays(spark, sf_dir):
    """Room responses that must have a delay."""
    r = table(spark, sf_dir, "region")
    return augment.checked_rirs(r.select(F.col("r_regionkey").alias("name")), r.select(F.col("r_regionkey").alias("name"), (F.col("r_regionkey") * 10).alias("delay"))).select("name", "delay")


# Reports and selections.


@query("SELECT lang AS status, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 2)::DOUBLE AS percent FROM documents GROUP BY lang")
def progress_by_status(spark, sf_dir):
    """Rows by status and their share."""
    d = table(spark, sf_dir, "documents").select(F.col("lang").alias("status"))
    return reports.progress(d, d.count()).select("status", "n", F.col("percent").cast("double").alias("percent"))


@query(f"WITH f AS ({FILES}), s AS (SELECT * FROM f WHERE suffix(path, '0')) SELECT path FROM s WHERE duration_in_sec * 1000 < 1048576 UNION ALL SELECT 'skipped ' || count(*) FROM s WHERE duration_in_sec * 1000 >= 1048576")
def files_within_size(spark, sf_dir):
    """Files under a size, and how many are not."""
    own, skipped = reports.within_size(files(spark, sf_dir).withColumn("length", F.col("duration_in_sec") * 1000), "0", 1.0)
    return own.select("path").unionByName(skipped.select(F.concat(F.lit("skipped "), F.col("skipped").cast("string")).alias("path")))


@query(f"WITH f AS ({FILES}) SELECT source, path FROM f QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('42|' || path), path) <= 7")
def sampled_members(spark, sf_dir):
    """A repeatable sample of each group."""
    return selection.sample_per_group(files(spark, sf_dir), ["source"], "path", 7).select("source", "path")


@query(f"WITH f AS ({FILES}) SELECT path FROM f ORDER BY path, id LIMIT 20 OFFSET 10")
def page_of_rows(spark, sf_dir):
    """Rows of a range."""
    return selection.page(files(spark, sf_dir), ["path", "id"], *selection.parse_range("10:30")).select("path")


@query(f"WITH f AS ({FILES}) SELECT path, row_number() OVER (ORDER BY path, id) AS row FROM f")
def numbered_files(spark, sf_dir):
    """O2: numbers over a total order, without one task for all."""
    return ordered.row_numbers(ordered.laid_out(files(spark, sf_dir), "path", "id"), ["path", "id"]).select("path", "row")


@query("SELECT source, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS path, 1::BIGINT AS n, n_chars::DOUBLE AS seconds FROM documents")
def cut_records(spark, sf_dir):
    """A record for each file of a chunk."""
    found = selection.cuts(selection.next_fit(packable(spark, sf_dir), 6000.0))
    return found.select("source", "path", F.size("segments").cast("long").alias("n"), F.round(F.aggregate("segments", F.lit(0.0), lambda a, s: a + s["end"] - s["start"]), 3).alias("seconds"))


# Jobs.


def users(spark, sf_dir) -> DataFrame:
    """A files table of the events' users, of two sources."""
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("value").alias("v"))
    return e.select(F.col("user_id").cast("string").alias("id"), F.concat(F.lit("u/"), F.col("user_id").cast("string")).alias("path"), F.lit(1e9).alias("duration_in_sec"), F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd").alias("source"))


def members(spark, sf_dir) -> DataFrame:
    """A cluster for each ten users: their speakers."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    at = F.floor(F.col("user_id") / 10)
    return e.select(F.concat(F.lit("line "), at.cast("string")).alias("line"), at.alias("at"), F.col("event_type").alias("sp"), F.col("user_id").cast("string").alias("f"), (F.col("user_id") % 10).alias("pos"))


@query("SELECT CAST(user_id AS VARCHAR) AS file_id, event_type AS speaker, round(sum(value), 2) AS seconds, CAST(count(*) AS BIGINT) AS segments FROM events WHERE user_id % 2 = 0 GROUP BY ALL")
def job_file_speakers(spark, sf_dir):
    """Speakers of the files of some sources, from their blobs."""
    none = spark.createDataFrame([], schemas.FILE_SPEAKERS)
    found = entrypoints.build_file_speakers(none, users(spark, sf_dir), rttm_blobs(spark, sf_dir), ["even"])
    return found.select("file_id", "speaker", F.round(F.col("duration_in_sec").cast("double"), 2).alias("seconds"), F.col("segments").cast("long").alias("segments"))


@query("WITH m AS (SELECT DISTINCT user_id, event_type FROM events) SELECT CAST(user_id AS VARCHAR) AS file_id, event_type AS speaker, 's_' || substr(md5('line ' || (user_id // 10) || chr(10)), 1, 10) AS global_speaker FROM m")
def job_named_clusters(spark, sf_dir):
    """Names of clusters given to their members' rows."""
    own = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("file_id"), F.col("event_type").alias("speaker")).agg(F.lit(None).cast("string").alias("global_speaker"))
    return entrypoints.name_clusters(own, members(spark, sf_dir))


@query("""WITH m AS (SELECT DISTINCT user_id, event_type, CASE WHEN event_type = 'error' THEN NULL WHEN user_id % 10 < 6 THEN 'm' ELSE 'f' END AS g FROM events),
 v AS (SELECT user_id // 10 AS c, count(*) FILTER (g = 'm') AS m, count(*) FILTER (g = 'f') AS f, count(*) FILTER (g = '-') AS u FROM m GROUP BY 1)
 SELECT CAST(user_id AS VARCHAR) AS file_id, event_type AS speaker, CASE WHEN v.m > v.f AND v.m > u THEN 'm' WHEN v.f > v.m AND v.f > u THEN 'f' ELSE '-' END AS gender FROM m JOIN v ON v.c = user_id // 10""")
def job_voted_genders(spark, sf_dir):
    """Every member gets its cluster's vote."""
    own = members(spark, sf_dir)
    predicted = own.where("sp <> 'error'").select("f", "sp", F.when(F.col("pos") < 6, "m").otherwise("f").alias("g"))
    return entrypoints.vote_genders(own.select(F.col("f").alias("file_id"), F.col("sp").alias("speaker"), F.lit(None).cast("string").alias("gender")), own, predicted)


@query("SELECT CAST(user_id AS VARCHAR) AS id, event_type AS sp, 'u/' || user_id AS path, round(value, 2) AS length FROM events WHERE event_type = 'click'")
def job_speaker_segments(spark, sf_dir):
    """Segments of asked speakers with their files' paths."""
    asked = table(spark, sf_dir, "events").where("event_type = 'click'").select(F.col("user_id").cast("string").alias("f"), F.col("event_type").alias("sp")).distinct()
    found = entrypoints.speaker_segments(asked, users(spark, sf_dir), rttm_blobs(spark, sf_dir))
    return found.select("id", "sp", "path", F.round(F.col("end") - F.col("start"), 2).alias("length"))


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, epoch_us(ts) / 1e9 + value, event_type) AS n FROM events)
 SELECT 'line ' || (user_id // 10) AS line, CAST(user_id AS VARCHAR) AS f, round(value, 2) AS length FROM s WHERE user_id // 10 >= 1 AND value >= 2
 QUALIFY row_number() OVER (PARTITION BY user_id // 10 ORDER BY user_id % 10, n) <= 10""")
def job_review_segments(spark, sf_dir):
    """A cluster's first segments of a least length."""
    found = entrypoints.review_segments(members(spark, sf_dir), rttm_blobs(spark, sf_dir), skip=1)
    return found.select("line", "f", F.round(F.col("end") - F.col("start"), 2).alias("length"))


# Processes, workers, memos and streams.


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, CASE WHEN n_nationkey % 5 = 0 THEN 'skipped' WHEN n_nationkey % 5 = 1 THEN 'not_found' ELSE 'success' END AS status, CASE WHEN n_nationkey % 5 > 1 THEN n_name END AS result FROM nation")
def process_results(spark, sf_dir):
    """A process for each file; files with an output are skipped, those without an input reported."""
    n = table(spark, sf_dir, "nation")
    own = n.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("path"))
    of = lambda kind, where: n.where(where).select(F.col("n_nationkey").cast("string").alias("id"), F.lit(kind).alias("type"), F.encode("n_name", "UTF-8").alias("content"))
    kv = of("out.txt", "n_nationkey % 5 = 0").unionByName(of("in.txt", "n_nationkey % 5 <> 1"))
    found = udf_slots.map_files(own, kv, ["out.txt"], ["in.txt"], "cp {input}/in.txt {output}")
    return found.select("id", "status", F.decode("result", "UTF-8").alias("result"))


_WORKER = "import sys, json\nfor line in sys.stdin:\n    t = json.loads(line)\n    print('loaded', flush=True)\n    print('wrk-res: ok' if t['input'] else 'wrk-res: error no input', flush=True)\n"


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, CASE WHEN n_nationkey % 4 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN n_nationkey % 4 = 0 THEN 'no input' END AS error FROM nation")
def worker_results(spark, sf_dir):
    """X2 and M6 to M12's worker: one process for each task, a line for each row."""
    n = F.col("n_nationkey")
    tasks = table(spark, sf_dir, "nation").select(n.cast("string").alias("id"), F.col("n_name").alias("input_wav"), F.when(n % 4 == 0, "").otherwise("in").alias("input"), F.lit("out").alias("output"))
    return udf_slots.map_worker(tasks, [sys.executable, "-c", _WORKER]).select("id", "status", "error")


@query("SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 3 = 0 THEN 'old' WHEN doc_id % 3 = 1 THEN CAST(octet_length(encode(coalesce(text, ''))) AS VARCHAR) END AS result, doc_id % 3 < 2 AS ok FROM documents")
def memoised_results(spark, sf_dir):
    """Results of the memo, of the function, and failures as data."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("doc_id") % 3 == 1, F.coalesce("text", F.lit(""))).otherwise(F.lit("?")).alias("text"), "doc_id")
    memo = d.select("id", F.encode(F.lit("old"), "UTF-8").alias("result"), F.lit(None).cast("string").alias("error"), (F.col("doc_id") % 3 == 0).alias("ok"))

    def make():
        def call(text):
            if text == "?":
                raise ValueError("no text")
            return str(len(text.encode())).encode()

        return call

    return udf_slots.memoised(d.drop("doc_id"), memo, make, "text").select("id", F.decode("result", "UTF-8").alias("result"), "ok")


@query("SELECT l_orderkey AS tar, 1::BIGINT AS files, 3::BIGINT AS done, true AS complete FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey HAVING count(*) = 3")
def tar_complete_stream(spark, sf_dir):
    """T2 as a stream: tars as soon as all of their files are done."""
    folder, out = folder_of(spark, "tar-events"), folder_of(spark, "tars-done")
    orders = table(spark, sf_dir, "orders").select(F.lit("tar_file").alias("type"), F.col("o_orderkey").cast("string").alias("tar"), F.lit("").alias("value"))
    lines = table(spark, sf_dir, "lineitem").select(F.lit("file_done").alias("type"), F.col("l_orderkey").cast("string").alias("tar"), F.lit("").alias("value"))
    orders.union(lines).coalesce(1).write.json(folder)  # one file, so one batch: a tar's later lines are known with its first
    events = spark.readStream.schema(schemas.AUGMENT_EVENT).json(folder)
    done = completeness.complete_tars(events).writeStream.format("parquet").option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start(out)
    done.awaitTermination()
    return spark.read.parquet(out).select(F.col("tar").cast("long").alias("tar"), "files", "done", "complete")


# Iterative operators: what must hold of any right result.


@query("SELECT count(*) AS nodes, true AS within_components, true AS connected, true AS better FROM embeddings")
def communities_quality(spark, sf_dir):
    """M1: communities cover all nodes, are connected parts of components, and raise modularity above that of components."""
    nodes, e = vectors(spark, sf_dir).select(F.col("id").alias("node")), written(near_edges(spark, sf_dir), "edges")
    found = written(graph.communities(nodes, e), "communities")
    whole = written(graph.components(nodes, e), "components")
    crossing = found.join(whole, "node").groupBy("community").agg(F.count_distinct("component").alias("n")).where("n > 1").isEmpty()
    a, b = (found.select(F.col("node").alias(n), F.col("community").alias(c)) for n, c in (("src", "c1"), ("dst", "c2")))
    parts = graph.components(nodes, e.join(a, "src").join(b, "dst").where("c1 = c2").select("src", "dst"))
    connected = parts.select("component").distinct().count() == found.select("community").distinct().count()
    better = graph.modularity(found, e) >= graph.modularity(whole.withColumnRenamed("component", "community"), e)
    return spark.createDataFrame([(found.count(), crossing, connected, better)], "nodes long, within_components boolean, connected boolean, better boolean")


@query("SELECT count(*) AS n, true AS banded, true AS better FROM embeddings")
def gender_model_quality(spark, sf_dir):
    """M3 and M4: letters follow the probabilities and their dead band, which rank the classes no worse than chance."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("emb"), F.when(F.col("label") % 2 == 0, "m").otherwise("f").alias("truth"))
    found = written(ml.predict_gender(ml.train_gender(v.withColumnRenamed("truth", "g")), v).select("truth", "g", "p"), "genders")
    wrong = F.when(F.col("g") == "m", F.col("p") < 0.7).when(F.col("g") == "f", F.col("p") > 0.3).otherwise((F.col("p") >= 0.7) | (F.col("p") <= 0.3))
    one = found.agg(F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("wrong"), F.avg(F.when(F.col("truth") == "m", F.col("p"))).alias("m"), F.avg(F.when(F.col("truth") == "f", F.col("p"))).alias("f"))
    return one.select("n", (F.col("wrong") == 0).alias("banded"), (F.col("m") >= F.col("f")).alias("better"))


@query("SELECT count(*) AS n, true AS in_range, true AS better FROM embeddings")
def kmeans_quality(spark, sf_dir):
    """Every vector has one of 16 units, and lies nearer to its unit's mean than to the mean of all, in sum."""
    v = vectors(spark, sf_dir)
    found = written(v.join(ml.units(ml.train_units(v, k=16), v).select("id", "unit"), "id").select("id", "unit", F.posexplode("emb").alias("i", "x")), "units")
    spread = lambda *by: found.groupBy("i", *by).agg((F.sum(F.col("x") * F.col("x")) - F.sum("x") * F.avg("x")).alias("s")).agg(F.sum("s").alias("s"))
    ids = found.groupBy("id").agg(F.count_distinct("unit").alias("units"), F.max("unit").alias("unit"))
    one = ids.agg(F.count(F.lit(1)).alias("n"), F.min((F.col("units") == 1) & F.col("unit").between(0, 15)).alias("in_range"))
    return one.crossJoin(spread("unit").withColumnRenamed("s", "own")).crossJoin(spread()).select("n", "in_range", (F.col("own") <= F.col("s")).alias("better"))


# Interval jobs that only a fold or a recursion can express.

ORACLES["reconciled_segments"] = f"""WITH RECURSIVE s AS ({SEGMENTS}), e AS (SELECT id, max("end") AS d FROM s GROUP BY id),
 r AS (SELECT s.id, speaker, start, "end" AS fin, speaker = 'view' AS music, d, row_number() OVER p AS n, lead(start) OVER p AS next_start, lead(speaker = 'view') OVER p AS next_music
       FROM s JOIN e ON s.id = e.id WINDOW p AS (PARTITION BY s.id ORDER BY start, speaker = 'view', event_id)),
 w AS (SELECT id, 0::BIGINT AS n, 0.0::DOUBLE AS here, 0.0::DOUBLE AS moved, ''::VARCHAR AS speaker, 0.0::DOUBLE AS low, 0.0::DOUBLE AS high, false AS kept FROM e
  UNION ALL SELECT id, n,
    CASE WHEN music THEN fin WHEN NOT kept OR next_start IS NULL THEN here WHEN fin <= next_start THEN fin + grow ELSE fin END,
    CASE WHEN kept AND fin <= next_start AND NOT next_music THEN grow ELSE 0 END, speaker,
    CASE WHEN n = 1 THEN greatest(begin, here) - least(greatest(begin, here) - here, 0.3) ELSE greatest(begin, here) END,
    CASE WHEN next_start IS NULL THEN fin + least(d - fin, 0.3) WHEN fin <= next_start THEN fin + grow ELSE next_start END, kept
   FROM (SELECT *, NOT music AND NOT (fin < here OR fin - begin < 0.2) AS kept, least((next_start - fin) / CASE WHEN next_music THEN 1 ELSE 2 END, 0.3) AS grow
         FROM (SELECT r.*, w.here, r.start - w.moved AS begin FROM w JOIN r ON r.id = w.id AND r.n = w.n + 1)))
 SELECT id, speaker, round(low, 3) AS start, round(high, 3) AS "end" FROM w WHERE kept AND high - low >= 0.2"""

_RELATIVE = f"""s AS ({SEGMENTS}), l AS (SELECT id, min(start) AS low FROM s GROUP BY id), v AS (SELECT s.id, start - low AS a, "end" - low AS b FROM s JOIN l ON s.id = l.id)"""
ORACLES["probe_windows"] = f"""WITH {_RELATIVE}, t AS (SELECT id, i * (sum(b - a) / 5 + 1) AS here FROM v, range(5) AS x(i) GROUP BY id, i),
 m AS (SELECT t.id, here, k AS length, CASE WHEN a >= here THEN a ELSE b - k END AS start, row_number() OVER (PARTITION BY t.id, here, k ORDER BY a, b) AS turn
       FROM t JOIN v ON v.id = t.id, (VALUES (5.0::DOUBLE), (3.0), (1.0)) AS z(k) WHERE b - a >= k AND (a >= here OR b >= here + k)),
 o AS (SELECT DISTINCT id, length, round(start, 6) AS near FROM m WHERE turn = 1), c AS (SELECT *, count(*) OVER (PARTITION BY id, length) AS n FROM o)
 SELECT id, length, round(near, 3) AS start FROM c QUALIFY length = max(CASE WHEN n > 1 OR length = 1 THEN length END) OVER (PARTITION BY id)"""
ORACLES["restored_time"] = f"""WITH s AS ({SEGMENTS}), l AS (SELECT id, min(start) AS low FROM s GROUP BY id), p AS (SELECT id, start, "end" FROM s WHERE speaker = 'view'),
 o AS (SELECT id, start, coalesce(sum("end" - start) OVER (PARTITION BY id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM p),
 c AS (SELECT s.id, event_id, start - low AS a, "end" - low AS b FROM s JOIN l ON s.id = l.id WHERE speaker = 'click'),
 t AS (SELECT id, event_id, unnest([a, b]) AS t FROM c), f AS (SELECT id, arg_min(start - off, off) AS first FROM o GROUP BY id),
 m AS (SELECT t.id, event_id, t + coalesce(o.start - o.off, first) AS x FROM t JOIN f ON f.id = t.id ASOF LEFT JOIN o ON o.id = t.id AND t.t >= o.off),
 g AS (SELECT id, event_id, min(x) AS a, max(x) AS b FROM m GROUP BY ALL)
 SELECT g.id, event_id, round(greatest(a, p.start), 3) AS start, round(least(b, p."end"), 3) AS "end" FROM g JOIN p ON p.id = g.id AND b > p.start AND a < p."end\""""
