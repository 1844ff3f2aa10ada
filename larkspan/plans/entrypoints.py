"""The engine's jobs, end to end: each composes operators over the files, kv and file_speakers tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.functions.scalars import cluster_name, six_digits, speaker_number
from larkspan.operators import audio, intervals, ml, ordered, reports, selection, votes
from larkspan.sinks import archives, artifacts
from larkspan.sinks import tables as keyed
from larkspan.sources import parsers, tables

RTTM, SEGMENTS, VAD, LANGUAGES, EMBEDDINGS = "audio.rttm", "audio.ina_segments", "vad.json", "lang_detect_speaker.jsonl", "speaker.embeddings.jsonl"
#: A source that isn't used, one of a speaker a file, and the least length of a kept segment.
UNUSED, ONE_SPEAKER, LEAST = "liepa3-old", "liepa3", 0.2


def index_folder(spark: SparkSession, files: DataFrame, folder: str, source: str, extensions: list[str], prefix: str = "") -> DataFrame:
    """Files table with a folder's audio files, and the durations of those that are wave files."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).where(tables.has_extension(F.col("path"), extensions))
    rows = tables.index_files(found.select("path", "length"), folder.removeprefix("file://"), source, prefix).drop("duration_in_sec")
    lengths = found.select(tables.file_id(F.concat(F.lit(prefix), tables.without_prefix(F.regexp_replace("path", "^file:/*", "/"), folder.removeprefix("file://")))).alias("id"), audio.wave_duration(F.col("content")).alias("duration_in_sec"))
    return keyed.insert_if_absent(files, rows.join(lengths, "id"), ["id"])


def import_artifacts(spark: SparkSession, kv: DataFrame, folder: str, names: list[str]) -> DataFrame:
    """kv with the artifacts of a folder; a blob that exists keeps its time of creation."""
    new = tables.read_blobs(spark, folder, names).withColumn("created_at", F.current_timestamp())
    return keyed.upsert(kv, new, ["id", "type"])


def segments_of(kv: DataFrame, kind: str = RTTM) -> DataFrame:
    return parsers.parse_rttm(tables.of_types(kv, kind), parsers.decoded(F.col("content")), uri="waveform")


def build_file_speakers(file_speakers: DataFrame, files: DataFrame, kv: DataFrame, sources: list[str]) -> DataFrame:
    """Durations, numbers of segments and languages of the speakers in the files of ``sources``."""
    own = kv.join(tables.files_of(files, sources).select("id"), "id", "left_semi")
    spoken = segments_of(own).withColumnRenamed("id", "file_id")
    durations = reports.speaker_durations(spoken).withColumn("duration_in_sec", F.col("duration_in_sec").cast("float"))
    found = parsers.parse_languages(tables.of_types(own, LANGUAGES), parsers.decoded(F.col("content")))
    pairs = F.transform("lang_res", lambda r: F.struct(r["lang"].alias("lang"), r["conf"].alias("conf")))
    languages = found.select(F.col("id").alias("file_id"), "speaker", votes.language_decision(pairs).alias("language"))
    return keyed.set_language(keyed.set_speaker_durations(file_speakers, durations), languages)


def name_clusters(file_speakers: DataFrame, clusters: DataFrame) -> DataFrame:
    """Global speakers of the clusters' members, named after the clusters' lines."""
    return keyed.apply_clusters(file_speakers, clusters.select(cluster_name(F.col("line")).alias("global_speaker"), "f", "sp"))


def vote_genders(file_speakers: DataFrame, clusters: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every member gets its cluster's vote over the members' predictions (f, sp, g)."""
    voted = votes.gender_vote(clusters.join(predictions, ["f", "sp"], "left"), ["line"], "g")
    members = clusters.join(voted, "line").select(F.col("f").alias("file_id"), F.col("sp").alias("speaker"), "gender")
    return keyed.apply_genders(file_speakers, members.dropDuplicates(["file_id", "speaker"]))


def global_speakers(clusters: DataFrame, file_speakers: DataFrame) -> DataFrame:
    """(sp, duration, duration_non_lt): clusters in their file's order, numbered from 0."""
    split = reports.split_durations(clusters.withColumn("cluster", F.col("at")), file_speakers)
    placed = ordered.row_numbers(ordered.laid_out(split, "cluster"), ["cluster"], "n")
    return placed.select(speaker_number(F.col("n") - 1).alias("sp"), "duration", "duration_non_lt")


def build_segments(files: DataFrame, kv: DataFrame, file_speakers: DataFrame) -> DataFrame:
    """Final segments: reconciled and merged speech with its speakers' data.

    Files without speech segments are left out; speakers without a row get '', and nulls of a row stay null.
    """
    known = files.where(~F.col("source").eqNullSafe(UNUSED)).select("id", "source", F.col("duration_in_sec").alias("duration"))
    speech = segments_of(kv).select("id", "speaker", "start", "end", F.lit(False).alias("music"), F.col("line_no").alias("pos"))
    noted = parsers.parse_segments(tables.of_types(kv, SEGMENTS), parsers.decoded(F.col("content"))).where("label = 'music'")
    music = noted.select("id", F.lit("music").alias("speaker"), "start", "end", F.lit(True).alias("music"), F.col("line_no").alias("pos"))
    rows = speech.unionByName(music.join(speech.select("id").distinct(), "id", "left_semi")).join(known, "id")
    single = F.col("source").startswith(ONE_SPEAKER)
    reconciled = intervals.reconcile(rows.where(~F.coalesce(single, F.lit(False))).drop("source"))
    merged = intervals.merge_neighbours(reconciled.unionByName(intervals.whole_file(rows.where(single))))
    own = file_speakers.select(F.col("file_id").alias("id"), "speaker", F.col("global_speaker").alias("gs"), "gender", F.rtrim(F.coalesce("language", F.lit(""))).alias("lang"), F.lit(True).alias("met"))
    default = lambda c: F.when(F.col("met"), F.col(c)).otherwise("").alias(c)
    joined = merged.join(own, ["id", "speaker"], "left").join(known.select("id", "source"), "id")
    return joined.select("source", "id", "speaker", default("gs"), default("gender"), default("lang"), F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


def select_segments(segments: DataFrame, take: float = 3600.0, male: float = 3000.0, female: float = 3600.0, seed: str = "42") -> DataFrame:
    """Segments that training uses, within each speaker's budget."""
    own = selection.eligible(segments, LEAST).withColumn("seg", F.xxhash64("id", "speaker", "start", "end"))
    return selection.select_budget(own, take, male, female, seed).drop("seg")


def build_cuts(segments: DataFrame, files: DataFrame) -> DataFrame:
    """(source, path, segments): a file's chosen segments by start; segments of unknown files are left out."""
    own = segments.join(files.select("id", "path"), "id")
    return own.groupBy("source", "id", "path").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("segments")).drop("id")


def chunks(cuts: DataFrame, seconds: float = 30.0, per_tar: int = 600) -> DataFrame:
    """(source, tar, chunk, path, pos, start, end): where each cut goes."""
    flat = cuts.select("source", "path", F.posexplode("segments").alias("pos", "s")).select("source", "path", F.col("pos").cast("long").alias("pos"), "s.*")
    return selection.tars(selection.next_fit(flat, seconds), per_tar)


def write_shards(placed: DataFrame, waves: DataFrame, folder: str, rate: int = 16000) -> DataFrame:
    """Cut the waves (path, content) and write <folder>/<source>/<tar>.tar of chunks; returns (archive, members)."""
    each = placed.groupBy("source", "tar", "chunk", "path").agg(F.min("pos").alias("pos"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ranges"))
    named = each.withColumn("member", F.concat_ws("/", "source", six_digits(F.col("tar")), F.concat(six_digits(F.col("chunk")), F.lit(".wav"))))
    pieces = named.join(waves, "path").withColumn("key", F.concat_ws("|", "member", "path"))
    parts = audio.cut_files(pieces.select("key", "content"), pieces.select("key", F.explode("ranges").alias("r")).select("key", "r.*"), "key", rate=rate)
    whole = audio.concat_files(parts.join(pieces.select("key", "member", "path", "pos"), "key"), "member", ["path", "pos"])
    dealt = whole.join(named.select("member", "source", "tar").distinct(), "member").withColumn("tar", six_digits(F.col("tar")))
    return archives.write_tars(dealt.withColumnRenamed("audio", "data"), ["source", "tar"], folder)


def embedding_segments(kv: DataFrame, files: DataFrame, seconds: float = 120.0, seed: str = "42") -> DataFrame:
    """(id, speaker, start, end): each speaker's solo speech, chopped, up to a total length."""
    spoken = segments_of(kv).withColumn("n", F.xxhash64("id", "line_no"))
    alone = intervals.solo(spoken, "n").join(spoken.select("id", "n", "speaker"), ["id", "n"]).join(files.select("id", "duration_in_sec"), "id")
    enough = alone.where(F.col("end") - F.col("start") >= intervals.least_length(F.col("duration_in_sec")))
    order = [selection.shuffled(seed, "id", "start"), "start"]
    return selection.until_budget(intervals.chop(enough), ["id", "speaker"], order, F.col("end") - F.col("start"), seconds).select("id", "speaker", "start", "end")


def one_speaker_from_vad(kv: DataFrame, files: DataFrame, source: str) -> DataFrame:
    """kv with RTTM blobs made of a source's VAD blobs; fails where one exists."""
    own = tables.of_types(kv, VAD).join(tables.files_of(files, [source]).select("id"), "id", "left_semi")
    made = artifacts.vad_to_rttm(parsers.parse_vad(own, parsers.decoded(F.col("content"))))
    new = made.select("id", F.lit(RTTM).alias("type"), F.encode("content", "UTF-8").alias("content"), F.current_timestamp().alias("created_at"))
    return keyed.insert_strict(kv, new, ["id", "type"])


def speaker_segments(wanted: DataFrame, files: DataFrame, kv: DataFrame) -> DataFrame:
    """Segments of requested (f, sp) pairs with their files' paths; a missing file or blob is an error."""
    asked = keyed.assert_all_found(wanted.withColumnRenamed("f", "id"), files, ["id"], "file")
    asked = keyed.assert_all_found(asked, tables.of_types(kv, RTTM), ["id"], "segments")
    return asked.join(files.select("id", "path"), "id").join(segments_of(kv).withColumnRenamed("speaker", "sp"), ["id", "sp"]).select("id", "sp", "path", "start", "end")


def review_segments(clusters: DataFrame, kv: DataFrame, least: float = 2.0, most: int = 10, skip: int = 0) -> DataFrame:
    """For labelling: a cluster's first segments of a least length, by member, then by line."""
    own = clusters.where(F.col("at") >= skip).join(segments_of(kv).select(F.col("id").alias("f"), F.col("speaker").alias("sp"), "start", "end", "line_no"), ["f", "sp"])
    return selection.first_n(own.where(F.col("end") - F.col("start") >= least), ["line"], ["pos", "line_no"], most)


def music_speech_totals(files: DataFrame, kv: DataFrame, megabytes: float = 50.0, suffix: str = ".m4a") -> dict[str, DataFrame]:
    """Seconds by label over the files under a size, the sizes' histogram, and the number of larger files."""
    small, skipped = reports.within_size(files, suffix, megabytes)
    found = parsers.parse_segments(tables.of_types(kv, SEGMENTS).join(small.select("id"), "id", "left_semi"), parsers.decoded(F.col("content")))
    return {"labels": reports.label_sums(found), "sizes": reports.histogram(small, "length", 10), "skipped": skipped}


def gender_training(clusters: DataFrame, labels: DataFrame, embeddings: DataFrame) -> DataFrame:
    return ml.training_set(clusters.withColumn("cluster", F.col("line")), labels, embeddings)


def detect_genders(model, clusters: DataFrame, embeddings: DataFrame, sample: int = 10, dead_band: float = 0.2, seed: str = "42") -> tuple[DataFrame, DataFrame]:
    """Predictions (f, sp, g) for a sample of each cluster's members, and the clusters they disagree in."""
    chosen = selection.sample_per_group(clusters.withColumn("member", F.concat_ws("|", "f", "sp")), ["line"], "member", sample, seed)
    predicted = ml.predict_gender(model, chosen.join(embeddings, ["f", "sp"]), dead_band)
    return predicted.select("f", "sp", "g"), votes.disagreement(predicted, "line").where("mixed")
