"""SQL of the registered queries for a second engine, written on its own from the operators' definitions."""

from __future__ import annotations

from larkspan.plans.relations import FILES, SEGMENTS, SPEAKERS

_CAPS = "(1), (2), (5), (10), (20), (50), (100), (200), (100000)"
_GENDERED = "SELECT d.source, d.doc_id, d.lang AS gs, CASE WHEN quality = 1 THEN 'm' WHEN quality = 0 THEN 'f' ELSE '-' END AS gender, CAST(n_chars AS DOUBLE) AS secs FROM documents d LEFT JOIN labels USING (doc_id)"
_FINAL = "SELECT event_id, CAST(user_id AS VARCHAR) AS gs, event_type AS id, CASE event_type WHEN 'view' THEN 'crawl' WHEN 'click' THEN 'liepa3-speaker' ELSE event_type END AS source, CASE WHEN event_type = 'error' THEN '' WHEN user_id < 75 THEN 'm' ELSE 'f' END AS gender, 0.0::DOUBLE AS start, value AS \"end\" FROM events"
_FOLDERS = f"""f AS ({FILES}), g AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS folder FROM f),
 h AS (SELECT *, CASE WHEN folder = lag(folder) OVER (ORDER BY path, id) THEN 0 ELSE 1 END AS fresh FROM g),
 r AS (SELECT *, CAST(sum(fresh) OVER (ORDER BY path, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM h)"""
_NEXT_FIT = f"""f AS ({FILES}), p AS (SELECT source, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS path, duration_in_sec AS secs,
   row_number() OVER (PARTITION BY source ORDER BY lpad(CAST(doc_id AS VARCHAR), 12, '0')) AS n FROM f),
 c AS (SELECT source, path, secs, n, secs AS held, 0::BIGINT AS chunk FROM p WHERE n = 1
   UNION ALL SELECT p.source, p.path, p.secs, p.n, CASE WHEN c.held + p.secs > 6000 THEN p.secs ELSE c.held + p.secs END,
     c.chunk + CASE WHEN c.held + p.secs > 6000 THEN 1 ELSE 0 END FROM c JOIN p ON p.source = c.source AND p.n = c.n + 1)"""
_EDGES = """v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
 s AS (SELECT a.vec_id AS src, b.vec_id AS dst, list_cosine_similarity(a.e, b.e) AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.3),
 k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) AS turn FROM s),
 edges AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, max(w) AS w FROM k WHERE turn <= 49 GROUP BY ALL)"""
_COMPONENTS = f"""{_EDGES}, two AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
 reach AS (SELECT vec_id AS node, vec_id AS top FROM v UNION SELECT r.node, t.dst FROM reach r JOIN two t ON t.src = r.top),
 comp AS (SELECT node, min(top) AS component FROM reach GROUP BY node)"""


def _index(kind: str, n: int) -> str:
    return f"(CAST('0x' || substr(md5('42|{kind}|' || path || '|' || variant), 1, 8) AS BIGINT) % {n})::INT + 1"


ORACLES = {
    "global_totals": f"WITH s AS ({SPEAKERS}), x AS (SELECT duration + duration_non_lt AS v FROM s) SELECT sum(v) AS total, median(v) AS median, avg(v) AS mean, count(v) AS n FROM x",
    "lt_totals": f"WITH s AS ({SPEAKERS}) SELECT sum(duration) AS total, avg(duration) AS mean, count(*) AS n FROM s WHERE duration > 0",
    "non_lt_totals": f"WITH s AS ({SPEAKERS}) SELECT sum(duration_non_lt) AS total, avg(duration_non_lt) AS mean, count(*) AS n FROM s WHERE duration_non_lt > 0",
    "top_speakers_lt": f"WITH s AS ({SPEAKERS}) SELECT sp, sum(duration) AS total FROM s WHERE duration > 0 GROUP BY sp ORDER BY total DESC, sp LIMIT 50",
    "top_speakers_non_lt": f"WITH s AS ({SPEAKERS}) SELECT sp, sum(duration_non_lt) AS total FROM s WHERE duration_non_lt > 0 GROUP BY sp ORDER BY total DESC, sp LIMIT 10",
    "cap_sweep": f"WITH s AS ({SPEAKERS}), h(h) AS (VALUES {_CAPS}) SELECT CAST(h AS DOUBLE) AS cap, sum(least(duration, h * 3600.0::DOUBLE)) AS capped, count_if(duration > h * 3600.0::DOUBLE)::BIGINT AS over, sum(duration) - sum(least(duration, h * 3600.0::DOUBLE)) AS trimmed, count(*) AS n FROM s, h WHERE duration > 0 GROUP BY h",
    "file_scan": f"WITH f AS ({FILES}) SELECT id, path, duration_in_sec, source FROM f ORDER BY path, id",
    "sources_scan": f"WITH f AS ({FILES}) SELECT id, path FROM f WHERE source IN ('src0', 'src1')",
    "speaker_durations": f"WITH s AS ({SEGMENTS}) SELECT id, speaker, round(sum(\"end\" - start), 3) AS duration_in_sec, CAST(count(*) AS INT) AS segments FROM s GROUP BY ALL",
    "speaker_split_durations": "SELECT source AS cluster, CAST(sum(CASE WHEN l.doc_id IS NOT NULL AND lang = 'en' THEN n_chars ELSE 0 END) AS DOUBLE) AS duration, CAST(sum(CASE WHEN l.doc_id IS NOT NULL AND lang <> 'en' THEN n_chars ELSE 0 END) AS DOUBLE) AS duration_non_lt FROM documents d LEFT JOIN (SELECT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY source",
    "source_gender_stats": f"WITH g AS ({_GENDERED}) SELECT source, gender, sum(secs) AS duration, sum(CASE WHEN source = 'crawl' THEN secs * 4 ELSE secs END) AS augmented, count(*) AS segments, count(DISTINCT gs) AS speakers, grouping(source) AS level FROM g GROUP BY GROUPING SETS ((source, gender), (gender))",
    "grand_totals": f"WITH g AS ({_GENDERED}), s AS (SELECT sum(secs) AS d, count(*) AS n, count(DISTINCT gs) AS k FROM g GROUP BY source, gender) SELECT sum(d) AS duration, CAST(sum(n) AS BIGINT) AS segments, CAST(sum(k) AS BIGINT) AS speakers FROM s",
    "eligible_segments": f"WITH f AS ({_FINAL}), l AS (SELECT *, sum(\"end\" - start) OVER (PARTITION BY gs, id) AS t FROM f WHERE gender <> '' AND \"end\" - start >= 0.2) SELECT event_id, CASE source WHEN 'liepa3-speaker' THEN 'liepa3' ELSE source END AS source, gs, gender FROM l WHERE t >= 3",
    "greedy_selection": f"""WITH RECURSIVE f AS ({_FINAL}), o AS (SELECT *, "end" - start AS d, row_number() OVER (PARTITION BY gs ORDER BY "end" - start > 30, md5('42|' || event_id), event_id) AS n FROM f),
 m AS (SELECT *, CASE gender WHEN 'm' THEN 60 WHEN 'f' THEN 90 END AS cap FROM o),
 w AS (SELECT gs, 0::BIGINT AS n, 0::BIGINT AS event_id, false AS took, 0.0::DOUBLE AS total, 0.0::DOUBLE AS crawl, false AS stop0, false AS stop1 FROM m GROUP BY gs
  UNION ALL SELECT gs, n, event_id, take, total + CASE WHEN take THEN d ELSE 0 END, crawl + CASE WHEN take AND source = 'crawl' THEN d ELSE 0 END,
   stop0 OR (NOT long AND halt), stop1 OR (long AND halt) FROM (SELECT *, NOT over AND NOT full_ AND total + d <= 400 AS take, NOT over AND NOT full_ AND total + d > 400 AND total + 30 > 400 AS halt FROM (
    SELECT m.gs, m.n, m.event_id, m.d, m.source, m.d > 30 AS long, w.total, w.crawl, w.stop0, w.stop1, CASE WHEN m.d > 30 THEN w.stop1 ELSE w.stop0 END AS over,
     coalesce(m.source = 'crawl' AND w.crawl + m.d > m.cap, false) AS full_ FROM w JOIN m ON m.gs = w.gs AND m.n = w.n + 1)))
 SELECT w.event_id, w.gs, f.source FROM w JOIN f USING (event_id) WHERE took""",
    "size_histogram": "WITH e AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents), b AS (SELECT CAST(floor((n_chars - lo) / ((hi - lo) / 10)) AS BIGINT) AS bin, lo, (hi - lo) / 10 AS w FROM documents, e), c AS (SELECT bin, round(min(lo + bin * w), 6) AS low, count(*) AS n FROM b GROUP BY bin) SELECT bin, low, n, CAST(sum(n) OVER (ORDER BY bin) AS BIGINT) AS running FROM c",
    "gender_vote": f"WITH g AS ({_GENDERED}), c AS (SELECT source, count(*) FILTER (gender = 'm') AS m, count(*) FILTER (gender = 'f') AS f, count(*) FILTER (gender = '-') AS u FROM g GROUP BY source) SELECT source, CASE WHEN m > f AND m > u THEN 'm' WHEN f > m AND f > u THEN 'f' ELSE '-' END AS gender FROM c",
    "language_decision": """WITH d AS (SELECT CAST(floor(doc_id / 6) AS BIGINT) AS grp, doc_id, lang, (n_chars % 100) / 100.0::DOUBLE AS conf FROM documents),
 c AS (SELECT grp, count(*) FILTER (lang = 'en') AS own, count(*) FILTER (lang <> 'en') AS other FROM d GROUP BY grp),
 b AS (SELECT grp, lang AS best, conf, row_number() OVER (PARTITION BY grp ORDER BY conf DESC, doc_id) AS n FROM d WHERE lang <> 'en')
 SELECT grp, CASE WHEN other = 0 THEN 'en' WHEN other = 1 AND own > 3 AND conf < 0.6 THEN 'en' WHEN conf > 0 THEN best ELSE '' END AS language FROM c LEFT JOIN (SELECT * FROM b WHERE n = 1) b USING (grp)""",
    "first_n_per_run": f"WITH {_FOLDERS}, t AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY path, id) AS turn FROM r) SELECT path, folder, run, CAST(turn AS INT) AS turn FROM t WHERE turn <= 2",
    "folder_islands": f"WITH {_FOLDERS} SELECT run, folder, count(*) AS n, arg_min(id, path) AS first FROM r GROUP BY run, folder",
    "middle_top5": f"WITH s AS ({SEGMENTS}), t AS (SELECT *, row_number() OVER (PARTITION BY id, speaker ORDER BY \"end\" - start DESC, start) AS turn FROM s WHERE \"end\" - start >= 5) SELECT event_id, turn, round(CASE WHEN \"end\" - start > 5 THEN (start + \"end\") / 2 - 2.5 ELSE start END, 3) AS start, round(CASE WHEN \"end\" - start > 5 THEN (start + \"end\") / 2 + 2.5 ELSE \"end\" END, 3) AS \"end\" FROM t WHERE turn <= 5",
    "chop_pieces": "WITH d AS (SELECT doc_id, n_chars / 10.0::DOUBLE AS e FROM documents), k AS (SELECT *, CASE WHEN e > 28 THEN CAST(ceil((e - 28) / 20) AS BIGINT) ELSE 0 END AS k FROM d), p AS (SELECT *, unnest(range(k + 1)) AS piece FROM k) SELECT doc_id, piece, round(piece * 20.0::DOUBLE, 6) AS start, round(CASE WHEN piece < k THEN piece * 20.0::DOUBLE + 20 ELSE e END, 6) AS \"end\" FROM p",
    "budget_cutoff": f"WITH f AS ({FILES}), b AS (SELECT *, coalesce(sum(duration_in_sec) OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM f) SELECT source, doc_id, before FROM b WHERE before < 20000",
    "next_fit_chunks": f"WITH RECURSIVE {_NEXT_FIT} SELECT source, path, chunk FROM c",
    "tar_assignment": f"WITH RECURSIVE {_NEXT_FIT} SELECT source, chunk // 5 AS tar, count(DISTINCT chunk) AS chunks, sum(secs) AS seconds FROM c GROUP BY ALL",
    "split_95": f"WITH f AS ({FILES}), o AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || path), path) AS n, count(*) OVER () AS total FROM f) SELECT CASE WHEN n <= CAST(floor(total * 0.95) AS INT) THEN 'train' WHEN n <= CAST(floor(total * 0.95) AS INT) + CAST(floor(total * 0.025) AS INT) THEN 'valid' ELSE 'test' END AS part, count(*) AS n, sum(duration_in_sec) AS seconds FROM o GROUP BY 1",
    "interval_overlap": f"WITH s AS ({SEGMENTS}) SELECT a.event_id, b.event_id AS r_event_id, round(greatest(a.start, b.start), 3) AS low, round(least(a.\"end\", b.\"end\"), 3) AS high FROM s a JOIN s b ON a.id = b.id AND a.speaker = 'click' AND b.speaker = 'view' AND a.\"end\" > b.start AND a.start < b.\"end\"",
    "asof_shift": f"WITH s AS ({SEGMENTS}), m AS (SELECT id, start AS mark, \"end\" - start AS shift FROM s WHERE speaker = 'view'), f AS (SELECT id, arg_min(shift, mark) AS first FROM m GROUP BY id) SELECT a.event_id, round(coalesce(m.shift, f.first), 3) AS shift FROM (SELECT * FROM s WHERE speaker <> 'view') a ASOF LEFT JOIN m ON a.id = m.id AND a.start >= m.mark LEFT JOIN f ON f.id = a.id",
    "speech_offsets": f"WITH s AS ({SEGMENTS}) SELECT event_id, round(coalesce(sum(\"end\" - start) OVER (PARTITION BY id ORDER BY start, \"end\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 3) AS \"offset\" FROM s WHERE speaker = 'view'",
    "solo_speech": f"""WITH s AS ({SEGMENTS}), e AS (SELECT id, start AS t, 1 AS d, event_id AS m FROM s UNION ALL SELECT id, "end", -1, -event_id FROM s),
 a AS (SELECT id, t, sum(d) AS d, sum(m) AS m FROM e GROUP BY id, t), o AS (SELECT id, t AS start, lead(t) OVER w AS "end", sum(d) OVER w AS depth, sum(m) OVER w AS event_id FROM a WINDOW w AS (PARTITION BY id ORDER BY t))
 SELECT CAST(event_id AS BIGINT) AS event_id, round(start, 3) AS start, round("end", 3) AS "end" FROM o WHERE depth = 1 AND "end" > start""",
    "w5_merge_segments": f"""WITH RECURSIVE s AS ({SEGMENTS}), o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY start, event_id) AS n FROM s),
 c AS (SELECT id, n, speaker, start, "end", 0 AS g FROM o WHERE n = 1
  UNION ALL SELECT o.id, o.n, o.speaker, CASE WHEN joined THEN first ELSE o.start END, o."end", g + CASE WHEN joined THEN 0 ELSE 1 END FROM (
   SELECT o.id, o.n, o.speaker, o.start, o."end", c.g, c.start AS first, o."end" - c.start <= 300 AND o.speaker = c.speaker AND o.start - c."end" < 0.3 AS joined FROM c JOIN o ON o.id = c.id AND o.n = c.n + 1) o)
 SELECT id, speaker, round(min(start), 3) AS start, round(arg_max("end", n), 3) AS "end" FROM c GROUP BY id, g, speaker""",
    "knn_edges": f"WITH {_EDGES} SELECT src, dst, round(w, 3) AS w FROM edges",
    "components": f"WITH RECURSIVE {_COMPONENTS} SELECT node, component FROM comp",
    "cluster_sizes": f"WITH RECURSIVE {_COMPONENTS}, z AS (SELECT count(*) AS size FROM comp GROUP BY component), y AS (SELECT size, count(*) AS clusters FROM z GROUP BY size) SELECT size, clusters FROM (SELECT * FROM y ORDER BY size DESC LIMIT 30) UNION SELECT size, clusters FROM y WHERE size = 1",
    "mean_norm": "SELECT round(avg(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))), 4) AS mean_norm FROM embeddings",
    "rttm_roundtrip": f"WITH s AS ({SEGMENTS}) SELECT id, speaker, round(round(start, 3), 2) AS start FROM s",
    "ina_parse": "SELECT CAST(user_id AS VARCHAR) AS id, event_type AS label, CAST(event_id AS DOUBLE) AS start, event_id + 0.5::DOUBLE AS \"end\" FROM events",
    "vad_to_rttm": "WITH t AS (SELECT CAST(user_id AS VARCHAR) AS id, string_agg('SPEAKER waveform 1 ' || event_id || '.000 1.000 <NA> <NA> SPEAKER_00 <NA> <NA>' || chr(10), '' ORDER BY event_id) AS content FROM events GROUP BY user_id) SELECT id, CAST(length(content) AS BIGINT) AS n_chars, md5(content) AS digest FROM t",
    "upsert_merge": "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, coalesce('q' || l.quality, d.lang) AS language, d.source, d.n_chars AS n FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id",
    "upsert_blobs": "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'q' || l.quality ELSE d.lang END AS language, CASE WHEN l.doc_id IS NOT NULL THEN 'new' ELSE d.source END AS source, CASE WHEN d.doc_id IS NOT NULL THEN d.n_chars ELSE 0 END AS n FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id",
    "insert_if_absent": "SELECT doc_id, 'q' || quality AS language FROM labels UNION ALL SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "update_by_key": "SELECT d.doc_id, coalesce('q' || l.quality, d.lang) AS language, d.source, d.n_chars AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "move_source": f"WITH {_FOLDERS}, t AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY path, id) AS turn FROM r) SELECT id, path, CASE WHEN turn = 1 THEN 'moved' ELSE source END AS source FROM t",
    "resume_pending": f"WITH f AS ({FILES}) SELECT id, path FROM f WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "collect_jsonl": "SELECT turn, role, CAST(conv_id AS VARCHAR) AS f FROM conversations",
    "kv_pivot": "SELECT l.doc_id, l.quality, l.toxic, d.n_chars FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id",
    "aug_plan": f"WITH f AS ({FILES}), v AS (SELECT path, unnest(range(3)) AS variant FROM f) SELECT path, variant, regexp_replace(path, '.*/', '') || '_0' || variant AS name, (['r0', 'r1', 'r2'])[{_index('rir', 3)}] AS rir, (['n0', 'n1'])[{_index('noise', 2)}] AS noise, (['mp3', 'ogg', 'none', 'none'])[{_index('codec', 4)}] AS codec FROM v",
    "tar_complete": "WITH e AS (SELECT o_orderkey AS tar, 1 AS f, 0 AS d FROM orders UNION ALL SELECT l_orderkey, 0, 1 FROM lineitem) SELECT tar, CAST(sum(f) AS BIGINT) AS files, CAST(sum(d) AS BIGINT) AS done, sum(f) > 0 AND sum(d) = 3 * sum(f) AS complete FROM e GROUP BY tar",
    "label_sums": f"WITH s AS ({SEGMENTS}) SELECT id, " + ", ".join(f"round(coalesce(sum(\"end\" - start) FILTER (speaker = '{x}'), 0), 3) AS {x}" for x in ("view", "click", "error")) + " FROM s GROUP BY id",
    "corpus_totals": "SELECT CAST(sum(n_chars) FILTER (lang <> 'de') AS BIGINT) AS total, count(*) FILTER (lang <> 'de') AS ok, count(*) FILTER (lang = 'de') AS failed FROM documents",
    "moving_average": "SELECT o_orderkey, round(avg(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 199 PRECEDING AND CURRENT ROW), 6) AS moving FROM orders",
    "cluster_disagreement": f"WITH g AS ({_GENDERED}) SELECT source, count(DISTINCT gender) AS labels, count(*) AS members, count(DISTINCT gender) > 1 AS mixed FROM g GROUP BY source",
    "scalar_functions": f"""WITH f AS ({FILES}), x AS (SELECT *, CAST(duration_in_sec * 10 AS BIGINT) AS s FROM f)
 SELECT doc_id, CASE WHEN s >= 86400 THEN (s // 86400) || 'd' || CASE WHEN s % 86400 // 3600 > 0 THEN ' ' || (s % 86400 // 3600) || 'h' ELSE '' END
   WHEN s >= 3600 THEN (s // 3600) || 'h' || CASE WHEN s % 3600 // 60 > 0 THEN ' ' || (s % 3600 // 60) || 'm' ELSE '' END
   WHEN s >= 60 THEN (s // 60) || 'm' || CASE WHEN s % 60 > 0 THEN ' ' || (s % 60) || 's' ELSE '' END ELSE s || 's' END AS took,
  regexp_replace(path, '/?[^/]*$', '') AS folder, regexp_replace(path, '.*/', '') AS name, lpad(CAST(doc_id AS VARCHAR), 6, '0') AS shard, 's_' || substr(md5(path || chr(10)), 1, 10) AS cluster, CASE WHEN starts_with(path, 'src/') THEN substr(path, 5) ELSE path END AS below FROM x""",
    "mapped_results": "SELECT CAST(doc_id AS VARCHAR) AS id, 'success' AS status, CAST(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) AS BIGINT) AS breaks FROM documents",
    "training_balance": f"""WITH g AS ({_GENDERED}), f AS (SELECT source, arg_min(gender, doc_id) AS g FROM g WHERE gender <> '-' GROUP BY source),
 m AS (SELECT g.doc_id, f.g, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn FROM g JOIN f USING (source)) SELECT g, count(*) AS n FROM m JOIN embeddings e ON e.vec_id = m.doc_id WHERE turn <= 201 GROUP BY g""",
    "ext_cube": "SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY CUBE (source, lang)",
    "ext_set_operations": "SELECT doc_id, 'both' AS kind FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'unlabelled' FROM (SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels)",
    "ext_hourly_counts": "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL",
    "ext_star_join": "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
}
