"""Queries of the core operators over the driver's tables, and the SQL that each is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import paths, text, vectors
from millrace.functions.strings import plain_hash
from millrace.operators import chunks, dedup, density, frames, gates, kernels, reports, similarity, splits, tables, tags
from millrace.operators.graph import connected_components
from millrace.plans.book import Book
from millrace.plans.pipeline import Pipeline, Result, Stage
from millrace.runtime import cut, scratch, spread
from millrace.sources.tables import table
from millrace.streaming import windows

BOOK = Book()
query = BOOK.query


HASH = r"trim(regexp_replace(lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')), '^sha256:', ''))"


# gates and scalar rules


@query("""
WITH m AS (SELECT *, lower(audio_format) f FROM audio_manifest),
r AS (SELECT audio_id, sample_rate, channels, f, CASE WHEN f IS NULL OR f NOT IN ('wav','flac','mp3','m4a','ogg') THEN 'unsupported_format: ' || coalesce(f, '')
  WHEN duration_sec < 1 THEN 'too_short' WHEN duration_sec > 600 THEN 'too_long' WHEN file_bytes > 209715200 THEN 'too_large' END reason FROM m)
SELECT audio_id, reason IS NULL AS ok, reason, CASE WHEN reason IS NULL THEN concat_ws(';', CASE WHEN sample_rate < 44100 THEN 'low_sample_rate:' || sample_rate END,
  CASE WHEN channels = 1 THEN 'mono_audio' END, CASE WHEN f IN ('mp3','m4a','ogg') THEN 'lossy_format' END) ELSE '' END AS tags FROM r""")
def ingest_check(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "audio_manifest", "audio_id", "audio_format", "duration_sec", "file_bytes", "sample_rate", "channels")
    m = gates.ingest_check(m, F.col("audio_format"), F.col("duration_sec"), F.col("file_bytes"), F.col("sample_rate"), F.col("channels"))
    return m.select("audio_id", "ok", "reason", F.array_join("tags", ";").alias("tags"))


@query("""
SELECT audio_id, len(l) = 0 AS passed, array_to_string(l, ';') AS reasons, array_to_string(w, ';') AS warnings FROM (SELECT audio_id,
  list_filter([CASE WHEN duration_s < 5 THEN 'too_short' END, CASE WHEN sample_rate > 0 AND sample_rate < 44100 THEN 'low_sample_rate' END], lambda x: x IS NOT NULL) l,
  list_filter([CASE WHEN duration_s > 600 AND NOT isnan(duration_s) THEN 'too_long' END, CASE WHEN loudness_lufs < 15 THEN 'low_snr' END], lambda x: x IS NOT NULL) w FROM audio_features)""")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "audio_features", "audio_id", "duration_s", "sample_rate", "loudness_lufs")
    f = gates.quality_gate(f, {"duration": F.col("duration_s"), "sample_rate": F.col("sample_rate"), "snr_db": F.col("loudness_lufs")})
    return f.select("audio_id", "passed", F.array_join("reasons", ";").alias("reasons"), F.array_join("warnings", ";").alias("warnings"))


@query("""
SELECT audio_id, s OR f AS candidate, concat_ws('; ', CASE WHEN s THEN 'snr' END, CASE WHEN f THEN 'spectral_flatness' END) AS reason FROM (SELECT audio_id,
  coalesce(loudness_lufs + 25 > 0 AND loudness_lufs + 25 < 15, false) s, coalesce(spectral_flatness_mean > 0.01 AND NOT isnan(spectral_flatness_mean), false) f FROM audio_features)""")
def noise_candidates(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "audio_features", "audio_id", "spectral_flatness_mean", "loudness_lufs")
    yes, why = gates.noise_candidate(F.col("loudness_lufs") + 25, F.col("spectral_flatness_mean"), gates.QualityRules(flatness=0.01))
    return f.select("audio_id", yes.alias("candidate"), why.alias("reason"))


@query("""
SELECT audio_id, concat_ws('', CASE WHEN track_slug IS NULL THEN 'missing_track_slug;' END, CASE WHEN file_bytes IS NULL THEN 'missing_file_bytes;' END,
  CASE WHEN sha256 IS NULL THEN 'missing_sha256;' END, CASE WHEN master_path IS NULL THEN 'missing_master_path;' END) AS quality_flags FROM audio_manifest""")
def missing_flags(spark: SparkSession, d: str) -> DataFrame:
    cols = ["track_slug", "file_bytes", "sha256", "master_path"]
    m = table(spark, d, "audio_manifest", "audio_id", *cols)
    return m.select("audio_id", gates.missing_flags(m, cols).alias("quality_flags"))


@query("SELECT doc_id, coalesce(lang, 'und') AS lang, coalesce(source, 'unknown') AS source FROM documents")
def fill_missing(spark: SparkSession, d: str) -> DataFrame:
    return gates.fill_missing(table(spark, d, "documents", "doc_id", "lang", "source"), {"lang": "und", "source": "unknown"})[0]


@query("SELECT count(*) FILTER (lang IS NULL) AS lang, count(*) FILTER (source IS NULL) AS source FROM documents")
def fill_counts(spark: SparkSession, d: str) -> DataFrame:
    return gates.fill_missing(table(spark, d, "documents", "doc_id", "lang", "source"), {"lang": "und", "source": "unknown"})[1]


@query("SELECT audio_path, coalesce(lang IN ('zh', 'en', 'yue'), false) AS allowed, lang_confidence < 0.6 AS is_low FROM language_cache")
def language_gate(spark: SparkSession, d: str) -> DataFrame:
    ok, note = gates.language_gate(F.col("lang"), F.col("lang_confidence"), ("zh", "en", "yue"), 0.6)
    c = table(spark, d, "language_cache", "audio_path", "lang", "lang_confidence")
    return c.select("audio_path", ok.alias("allowed"), F.when(F.col("lang_confidence").isNotNull(), note.isNotNull()).alias("is_low"))


@query("""
SELECT track_id FROM yamnet_output WHERE NOT (NOT coalesce(is_music, true) AND (coalesce(has_speech, false) OR coalesce(has_noise, false)))""")
def content_gate(spark: SparkSession, d: str) -> DataFrame:
    y = table(spark, d, "yamnet_output", "track_id", "is_music", "has_speech", "has_noise")
    return y.where(~gates.content_rejects(F.col("is_music"), F.col("has_speech"), F.col("has_noise"))).select("track_id")


_WORDS = ", ".join(f"'{w}'" for w in gates.NON_MUSIC_WORDS)


@query(f"""
WITH j AS (SELECT DISTINCT m.audio_id, m.original_filename n, m.duration_sec d, y.silence_ratio s, f.spectral_flatness_mean q FROM audio_manifest m LEFT JOIN yamnet_output y ON m.audio_id = y.track_id LEFT JOIN audio_features f ON m.audio_id = f.audio_id),
r AS (SELECT *, CASE WHEN s > 0.2 AND NOT isnan(s) THEN 1 WHEN d < 30 THEN 2 WHEN len(list_filter([{_WORDS}], lambda w: contains(lower(n), w))) > 0 THEN 3 WHEN q > 0.03 AND NOT isnan(q) THEN 4 END k FROM j)
SELECT audio_id, d AS duration, s AS silence, q AS flatness, n AS name, ['silence', 'short', 'file_name', 'flat_spectrum'][k] AS rule, [0.1, 0.2, 0.15, 0.2][k]::DOUBLE AS score FROM r""")
def music_rules(spark: SparkSession, d: str) -> DataFrame:
    """The rules at limits that the tables meet."""
    m = table(spark, d, "audio_manifest", "audio_id", F.col("original_filename").alias("name"), F.col("duration_sec").alias("duration"))
    y = table(spark, d, "yamnet_output", F.col("track_id").alias("y"), F.col("silence_ratio").alias("silence"))
    f = table(spark, d, "audio_features", F.col("audio_id").alias("f"), F.col("spectral_flatness_mean").alias("flatness"))
    j = m.join(y, m["audio_id"] == y["y"], "left").join(f, m["audio_id"] == f["f"], "left").select("audio_id", "name", "duration", "silence", "flatness").distinct()
    hit = gates.music_rules(F.col("silence"), F.col("duration"), F.col("name"), F.col("flatness"), silent=0.2, short=30.0, flat=0.03)
    return j.select("*", hit["rule"].alias("rule"), hit["score"].alias("score"))


@query("""
SELECT audio_id, round((0.6 * CASE WHEN cv > 0.2 AND cv < 1 THEN greatest(0, least(1, 1 - abs(cv - 0.5) / 0.5)) ELSE 0.2 END + 0.5 * least(1, b / 50) + 0.5 * CASE WHEN h > 0.3 AND h < 0.9 THEN greatest(0, least(1, 1 - abs(h - 0.6) / 0.4)) ELSE 0.3 END
  + 0.4 * CASE WHEN z > 0.02 AND z < 0.4 THEN greatest(0, least(1, 1 - abs(z - 0.15) / 0.2)) ELSE 0.3 END) / (2.0 + 1e-10), 6) AS score
FROM (SELECT audio_id, rms_std / nullif(rms_mean, 0) cv, zcr_std b, zcr_mean z, (dominant_note + 1) / 13.0 h FROM audio_features WHERE dominant_note IS NOT NULL AND isfinite(rms_mean) AND isfinite(rms_std) AND isfinite(zcr_mean) AND isfinite(zcr_std))""")
def music_score(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "audio_features", "audio_id", "rms_mean", "rms_std", "zcr_mean", "zcr_std", "dominant_note").where("dominant_note IS NOT NULL")
    for c in f.columns[1:5]:
        f = f.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    cv = F.col("rms_std") / F.nullif(F.col("rms_mean"), F.lit(0.0))
    score, _ = gates.music_score(cv, F.col("zcr_std"), (F.col("dominant_note") + 1) / 13.0, F.col("zcr_mean"))
    return f.select("audio_id", F.round(score, 6).alias("score"))


@query("""
SELECT audio_id, concat_ws(';', CASE WHEN lower(audio_format) <> 'wav' THEN 'format:' || lower(audio_format) || '>wav' END,
  CASE WHEN sample_rate <> 44100 THEN 'sample_rate:' || sample_rate || '>44100' END, CASE WHEN channels <> 2 THEN 'channels:' || channels || '>2' END) AS repairs FROM audio_manifest""")
def repairs(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "audio_manifest", "audio_id", "audio_format", "sample_rate", "channels")
    return m.select("audio_id", F.array_join(gates.repairs(F.col("audio_format"), F.col("sample_rate"), F.col("channels")), ";").alias("repairs"))


@query("""
SELECT audio_id, regexp_full_match(upper(audio_id), '[0-9A-HJKMNP-TV-Z]{26}') AS valid, 'audio/' || md5(upper(audio_id))[1:2] || '/' || md5(upper(audio_id))[3:4] || '/' || md5(upper(audio_id)) || '_' || upper(audio_id) || '.flac' AS path
FROM split_ids WHERE audio_id IS NOT NULL""")
def sharded_paths(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "split_ids", "audio_id").where("audio_id IS NOT NULL")
    return s.select("audio_id", paths.valid_id(F.col("audio_id")).alias("valid"), paths.sharded_path("audio", F.col("audio_id"), F.lit("flac")).alias("path"))


@query(r"""
SELECT file_relative_path, regexp_extract(file_relative_path, '([^/\\]*)$', 1) AS name, upper(nullif(regexp_extract(regexp_replace(regexp_extract(file_relative_path, '([^/\\]*)$', 1), '\.[^.]*$', ''), '^[^_]*_(.*)$', 1), '')) AS id_in_name
FROM raw_audio_checksums WHERE file_relative_path IS NOT NULL""")
def ids_from_names(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_audio_checksums", "file_relative_path").where("file_relative_path IS NOT NULL")
    return r.select("file_relative_path", paths.base_name(F.col("file_relative_path")).alias("name"), paths.id_in_name(F.col("file_relative_path")).alias("id_in_name"))


@query("SELECT audio_id, CASE WHEN regexp_matches(bit_depth, 'PCM_(8|16|24|32)') THEN CAST(regexp_extract(bit_depth, 'PCM_(8|16|24|32)', 1) AS INT) WHEN upper(bit_depth) LIKE '%FLOAT%' THEN 32 WHEN upper(bit_depth) LIKE '%DOUBLE%' THEN 64 ELSE 0 END AS bits FROM audio_manifest")
def bit_depths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "audio_manifest", "audio_id", "bit_depth").select("audio_id", gates.bit_depth(F.col("bit_depth")).alias("bits"))


# text


@query(r"""
SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}')) AS email,
  regexp_replace(text, '[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}', '[REDACTED]', 'g') AS clean FROM documents""")
def email_redacted(spark: SparkSession, d: str) -> DataFrame:
    df, _ = text.redact(table(spark, d, "documents", "doc_id", "text"), "text", ("email",))
    return df.select("doc_id", F.col("n_email").cast("bigint").alias("email"), F.col("text").alias("clean"))


def _safety_sql() -> str:
    parts = [f"{w * 0.2} * CAST(contains(lower(t), '{k}') AS INT)" for w, ks in text.SAFETY_KEYWORDS.values() for k in ks]
    parts += [f"{w * 0.15} * len(regexp_extract_all(t, '(?i){p}'))" for w, p in text.SAFETY_PATTERNS.values()]
    return f"SELECT doc_id, round(s, 6) AS score, s < 0.5 AS safe FROM (SELECT doc_id, least(1.0, {' + '.join(parts)})::DOUBLE s FROM (SELECT doc_id, coalesce(text, '') t FROM documents))"


@query(_safety_sql())
def text_safety(spark: SparkSession, d: str) -> DataFrame:
    score, _, _, safe = text.safety(F.col("text"))
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.round(score, 6).alias("score"), safe.alias("safe"))


@query("SELECT event_type AS tag, count(*) AS n, arg_min(event_id, (ts, event_id)) AS sample FROM events GROUP BY 1")
def tag_frequency(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events", "event_type", "event_id", "ts")
    return tags.frequency(e, "event_type", "event_id", "ts").withColumnRenamed("event_type", "tag")


@query("SELECT c_mktsegment, arg_max(c_custkey, c_acctbal) AS c_custkey FROM customer GROUP BY 1")
def reverse_index(spark: SparkSession, d: str) -> DataFrame:
    return tags.reverse_index(table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_acctbal"), "c_custkey", "c_mktsegment", "c_acctbal")


# joins and inventories


@query("""
SELECT count(*) AS left_rows, coalesce(sum(n), 0)::BIGINT AS joined_rows, round(coalesce(sum(n), 0) / count(*) * 100, 2) AS hit_percent
FROM audio_manifest m LEFT JOIN (SELECT audio_id, count(*) n FROM audio_features GROUP BY 1) f ON m.audio_id = f.audio_id""")
def join_hit_rate(spark: SparkSession, d: str) -> DataFrame:
    return tables.hit_rate(table(spark, d, "audio_manifest", "audio_id"), table(spark, d, "audio_features", "audio_id"), "audio_id", "audio_id")


@query("SELECT DISTINCT audio_id FROM split_ids WHERE audio_id IS NOT NULL AND audio_id NOT IN (SELECT audio_id FROM audio_manifest WHERE audio_id IS NOT NULL) ORDER BY 1 LIMIT 10")
def unmatched_keys(spark: SparkSession, d: str) -> DataFrame:
    return tables.unmatched(table(spark, d, "split_ids", "audio_id"), table(spark, d, "audio_manifest", "audio_id"), "audio_id", "audio_id")


@query("""
SELECT m.audio_id, m.audio_format, f.bpm FROM audio_manifest m
LEFT JOIN (SELECT audio_id, arg_max(bpm, (duration_s, bpm)) bpm FROM audio_features WHERE duration_s IS NOT NULL AND bpm IS NOT NULL GROUP BY 1) f ON m.audio_id = f.audio_id""")
def feature_lookup(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "audio_features", "audio_id", "duration_s", "bpm").where("duration_s IS NOT NULL AND bpm IS NOT NULL")
    return tables.lookup(table(spark, d, "audio_manifest", "audio_id", "audio_format"), f, "audio_id", "bpm", "duration_s")


@query("""
SELECT a.audio_id, coalesce(b.file_bytes, a.file_bytes) AS file_bytes FROM raw_audio_checksums a
LEFT JOIN (SELECT audio_id, max(file_bytes) file_bytes FROM storage_checksums GROUP BY 1) b ON a.audio_id = b.audio_id""")
def patched(spark: SparkSession, d: str) -> DataFrame:
    changes = table(spark, d, "storage_checksums", "audio_id", "file_bytes").groupBy("audio_id").agg(F.max("file_bytes").alias("file_bytes"))
    return tables.patch(table(spark, d, "raw_audio_checksums", "audio_id", "file_bytes"), changes, "audio_id", ["file_bytes"])


@query("""
WITH a AS (SELECT file_relative_path p, max(file_bytes) s, max(sha256) c FROM raw_audio_checksums WHERE file_relative_path IS NOT NULL GROUP BY 1),
b AS (SELECT file_relative_path p, max(file_bytes) s, max(sha256) c FROM storage_checksums WHERE file_relative_path IS NOT NULL GROUP BY 1)
SELECT coalesce(a.p, b.p) AS file_relative_path, CASE WHEN b.p IS NULL THEN 'missing' WHEN a.p IS NULL THEN 'extra' WHEN a.s IS DISTINCT FROM b.s THEN 'size_mismatch' WHEN a.c <> b.c THEN 'checksum_mismatch' ELSE 'ok' END AS status
FROM a FULL JOIN b ON a.p = b.p""")
def inventory_diff(spark: SparkSession, d: str) -> DataFrame:
    side = lambda t: table(spark, d, t, "file_relative_path", "file_bytes", "sha256").where("file_relative_path IS NOT NULL").groupBy("file_relative_path").agg(F.max("file_bytes").alias("file_bytes"), F.max("sha256").alias("sha256"))
    return tables.inventory_diff(side("raw_audio_checksums"), side("storage_checksums"), "file_relative_path", "file_bytes", "sha256")


@query("""
SELECT m.audio_id, CASE WHEN r.k IS NULL THEN 'missing' WHEN coalesce(r.c, '') = '' THEN 'no_checksum' WHEN r.c IS NOT DISTINCT FROM m.sha256 THEN 'verified' ELSE 'mismatch' END AS status
FROM audio_manifest m LEFT JOIN (SELECT audio_id k, max(sha256) c FROM raw_audio_checksums GROUP BY 1) r ON m.audio_id = r.k""")
def checksum_status(spark: SparkSession, d: str) -> DataFrame:
    return tables.verify_checksums(table(spark, d, "audio_manifest", "audio_id", "sha256"), table(spark, d, "raw_audio_checksums", "audio_id", "sha256"), "audio_id", "sha256")


@query("""
SELECT user_id, p AS present, CASE WHEN p = 3 THEN 'complete' WHEN p > 0 THEN 'partial' ELSE 'missing' END AS status
FROM (SELECT user_id, count(DISTINCT event_type) FILTER (event_type IN ('click', 'purchase', 'error')) p FROM events GROUP BY 1)""")
def item_completeness(spark: SparkSession, d: str) -> DataFrame:
    return tables.completeness(table(spark, d, "events", "user_id", "event_type"), "user_id", "event_type", ["click", "purchase", "error"])


@query("""
SELECT audio_id, file_bytes FROM raw_audio_checksums UNION ALL
SELECT audio_id, file_bytes FROM storage_checksums WHERE audio_id NOT IN (SELECT audio_id FROM raw_audio_checksums WHERE audio_id IS NOT NULL)""")
def appended(spark: SparkSession, d: str) -> DataFrame:
    return tables.append_new(table(spark, d, "raw_audio_checksums", "audio_id", "file_bytes"), table(spark, d, "storage_checksums", "audio_id", "file_bytes"), "audio_id")


@query("""
WITH u AS (SELECT 0 s, audio_id, import_timestamp, file_bytes FROM raw_audio_checksums UNION ALL SELECT 1, audio_id, import_timestamp, file_bytes FROM storage_checksums)
SELECT audio_id, import_timestamp, file_bytes FROM (SELECT *, row_number() OVER (PARTITION BY audio_id ORDER BY s DESC, import_timestamp DESC NULLS LAST, file_bytes DESC NULLS LAST) r FROM u) WHERE r = 1""")
def upserted(spark: SparkSession, d: str) -> DataFrame:
    cols = ("audio_id", "import_timestamp", "file_bytes")
    return tables.upsert_last([table(spark, d, "raw_audio_checksums", *cols), table(spark, d, "storage_checksums", *cols)], "audio_id", ["import_timestamp"])


# aggregates


EVENT_SETS = {"music": ("click", "view"), "speech": ("signup",), "vocals": ("purchase",), "noise": ("error",), "silence": ("logout",)}


def _frames_sql() -> str:
    names = {k: ", ".join(f"'{x}'" for x in v) for k, v in EVENT_SETS.items()}
    parts = ", ".join(f"count(*) FILTER (event_type IN ({v}) AND value > 40) g_{k}, count(*) FILTER (event_type IN ({v})) a_{k}" for k, v in names.items())
    share = ", ".join(f"CASE WHEN n > 0 THEN g_{k} / n ELSE a_{k} / t END AS {k}_ratio" for k in names)
    out = ", ".join(f"{k}_ratio > {frames.LIMITS[k]} AS {frames.NAMES[k]}, {k}_ratio" for k in names)
    return f"""
WITH g AS (SELECT user_id, count(*) t, count(*) FILTER (value > 40) n, {parts} FROM events GROUP BY 1), s AS (SELECT user_id, t, CASE WHEN n > 0 THEN n ELSE t END h, {share} FROM g)
SELECT user_id, {out}, t AS total_frames, h AS high_confidence_frames FROM s"""


@query(_frames_sql())
def frame_to_item(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events", "user_id", "event_type", "value")
    return frames.frame_to_item(e, "user_id", "event_type", F.col("value"), 40.0, EVENT_SETS)


@query("""
WITH c AS (SELECT user_id, event_type, count(*) n, min(ts) f FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f, event_type) k FROM c)
SELECT user_id, string_agg(event_type || ':' || n, '; ' ORDER BY k) AS top FROM r WHERE k <= 5 GROUP BY 1""")
def top_tags(spark: SparkSession, d: str) -> DataFrame:
    return frames.top_tags(table(spark, d, "events", "user_id", "event_type", "ts"), "user_id", "event_type", "ts")


@query("""
WITH x AS (SELECT user_id, epoch_us(ts) / 1e6 t FROM events), y AS (SELECT user_id, t, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) d FROM x)
SELECT user_id, count(*) AS n, round(avg(d), 3) AS mean, round(stddev_pop(d), 3) AS std, round(min(d), 3) AS min, round(max(d), 3) AS max, min(t) AS first, max(t) AS last FROM y GROUP BY 1""")
def interval_stats(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events", "user_id", "ts")
    s = frames.interval_stats(e, "user_id", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return s.select("user_id", "n", *[F.round(c, 3).alias(c) for c in ("mean", "std", "min", "max")], "first", "last")


@query("""
SELECT user_id, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max, median(value) AS median,
  avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END) AS high_share FROM events GROUP BY 1""")
def series_stats(spark: SparkSession, d: str) -> DataFrame:
    s = frames.series_stats(table(spark, d, "events", "user_id", "value"), "user_id", F.col("value"), F.col("value"), {"high": 50.0})
    return s.select("user_id", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max", "median", "high_share")


@query("SELECT lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.value_counts(table(spark, d, "documents", "lang"), "lang")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS std, min({c}) AS min, max({c}) AS max FROM audio_features WHERE NOT isnan({c})" for c in ("duration_s", "bpm", "n_beats")).replace("NOT isnan(n_beats)", "true"))
def feature_summary(spark: SparkSession, d: str) -> DataFrame:
    cols = ["duration_s", "bpm", "n_beats"]
    s = reports.summary(table(spark, d, "audio_features", *cols), cols)
    return s.select("column", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max")


@query("""
SELECT CASE WHEN bpm = 180 THEN 30 WHEN bpm < 60 THEN 0 WHEN bpm > 180 THEN 31 ELSE floor((bpm - 60) / 4) + 1 END::BIGINT AS bin, count(*) AS n
FROM audio_features WHERE bpm IS NOT NULL AND NOT isnan(bpm) GROUP BY 1""")
def bpm_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reports.histogram(table(spark, d, "audio_features", "bpm"), "bpm", 60, 180)


@query("""
SELECT dominant_note_name, count(*) AS n, quantile_cont(bpm, 0.25) AS q1, quantile_cont(bpm, 0.5) AS median, quantile_cont(bpm, 0.75) AS q3
FROM audio_features WHERE bpm IS NOT NULL AND NOT isnan(bpm) GROUP BY 1""")
def bpm_box(spark: SparkSession, d: str) -> DataFrame:
    return reports.box(table(spark, d, "audio_features", "bpm", "dominant_note_name"), "bpm", "dominant_note_name")


@query("""
SELECT 'lang' AS "column", count(DISTINCT lang) AS n_distinct, count(DISTINCT lang) < 20 AS is_categorical FROM documents UNION ALL
SELECT 'source', count(DISTINCT source), count(DISTINCT source) < 20 FROM documents UNION ALL SELECT 'audio_id', count(DISTINCT audio_id), count(DISTINCT audio_id) < 20 FROM documents""")
def categorical_columns(spark: SparkSession, d: str) -> DataFrame:
    return reports.categorical(table(spark, d, "documents", "lang", "source", "audio_id"))


@query("SELECT count(*) AS files, sum(file_bytes)::BIGINT AS bytes FROM audio_manifest")
def manifest_totals(spark: SparkSession, d: str) -> DataFrame:
    return reports.totals(table(spark, d, "audio_manifest", "file_bytes"), "file_bytes")


@query("""
WITH a AS (SELECT count(*) n FROM audio_manifest), b AS (SELECT count(*) n FROM audio_manifest WHERE status = 'active'), c AS (SELECT count(*) n FROM audio_manifest WHERE status = 'active' AND duration_sec >= 5)
SELECT 0 AS ord, 'manifest' AS stage, a.n AS n, 100.0 AS retention FROM a UNION ALL SELECT 1, 'active', b.n, round(b.n / a.n * 100, 2) FROM a, b UNION ALL SELECT 2, 'long_enough', c.n, round(c.n / a.n * 100, 2) FROM a, c""")
def stage_funnel(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "audio_manifest", "status", "duration_sec")
    active = m.where("status = 'active'")
    return reports.funnel([("manifest", m), ("active", active), ("long_enough", active.where("duration_sec >= 5"))])


@query("""
SELECT split_name, count(*) AS n, count(DISTINCT audio_id) AS n_distinct, count(audio_id) - count(DISTINCT audio_id) AS repeated FROM split_ids GROUP BY 1""")
def split_id_totals(spark: SparkSession, d: str) -> DataFrame:
    return reports.id_totals(table(spark, d, "split_ids", "split_name", "audio_id"), "split_name", "audio_id")


@query("""
WITH m AS (SELECT DISTINCT audio_id, file_relative_path p FROM audio_manifest), i AS (SELECT DISTINCT file_relative_path q FROM storage_checksums WHERE file_relative_path IS NOT NULL)
SELECT audio_id, min(CASE WHEN a.q IS NOT NULL THEN a.q WHEN b.q IS NOT NULL THEN b.q END) AS file_relative_path FROM m LEFT JOIN i a ON m.p = a.q LEFT JOIN i b ON './' || m.p = b.q GROUP BY 1""")
def resolved_paths(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "audio_manifest", "audio_id", "file_relative_path").distinct()
    p = F.col("file_relative_path")
    return tables.resolve_path(m, "audio_id", [p, F.concat(F.lit("./"), p)], table(spark, d, "storage_checksums", "file_relative_path"), "file_relative_path")


@query("SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 500) AS BIGINT) AS batch FROM orders")
def order_batches(spark: SparkSession, d: str) -> DataFrame:
    return tables.batches(table(spark, d, "orders", "o_orderkey"), [F.col("o_orderkey")], 500)


@query("""
SELECT audio_path, CASE WHEN lang IS NOT NULL THEN lang ELSE 'en' END AS lang FROM (SELECT audio_path, max(lang) lang FROM language_cache WHERE audio_path IS NOT NULL GROUP BY 1)""")
def remembered_languages(spark: SparkSession, d: str) -> DataFrame:
    """Cached languages where there are any, the fallback where there are none."""
    c = table(spark, d, "language_cache", "audio_path", "lang").where("audio_path IS NOT NULL").groupBy("audio_path").agg(F.max("lang").alias("lang"))
    got, _ = kernels.remembered(c.select("audio_path"), c.where("lang IS NOT NULL"), "audio_path", lambda m: m.withColumn("lang", F.lit("en")))
    return got


# windows


@query("""
WITH x AS (SELECT DISTINCT audio_id, duration_s t FROM audio_features WHERE duration_s >= 5 AND NOT isnan(duration_s)), y AS (SELECT audio_id, t, unnest(generate_series(0, CAST(greatest(1, ceil(t / 15)) AS INT) - 1)) n FROM x)
SELECT audio_id || '_chunk' || lpad(CAST(n AS VARCHAR), 4, '0') AS chunk_id, audio_id, n::INT AS n, round(n * 15.0::DOUBLE, 3) AS start_time, round(least(n * 15.0::DOUBLE + 30, t), 3) AS end_time, round(least(n * 15.0::DOUBLE + 30, t) - n * 15.0::DOUBLE, 3) AS duration
FROM y WHERE n * 15.0 < t AND (least(n * 15.0::DOUBLE + 30, t) - n * 15.0::DOUBLE >= 5 OR n = 0)""")
def sliding_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunks.sliding_chunks(table(spark, d, "audio_features", "audio_id", "duration_s").distinct(), "audio_id", F.col("duration_s"))


@query("""
WITH x AS (SELECT audio_id, duration_s t FROM audio_features WHERE duration_s > 0 AND NOT isnan(duration_s)), y AS (SELECT audio_id, t, unnest(generate_series(0, CAST(ceil(t / 30) AS INT) - 1)) n FROM x)
SELECT audio_id, n::INT AS n, n * 30.0::DOUBLE AS start, least((n + 1) * 30.0::DOUBLE, t) AS "end" FROM y""")
def item_blocks(spark: SparkSession, d: str) -> DataFrame:
    return chunks.blocks(table(spark, d, "audio_features", "audio_id", "duration_s"), "audio_id", F.col("duration_s"))


@query("""
WITH x AS (SELECT audio_id, duration_s t FROM audio_features WHERE duration_s IS NOT NULL AND NOT isnan(duration_s)), y AS (SELECT audio_id, t, unnest(generate_series(0, CAST(greatest(1, floor((t - 10) / 5) + 1) AS INT) - 1)) n FROM x)
SELECT audio_id, n::INT AS n, n * 5.0::DOUBLE AS start, least(n * 5.0::DOUBLE + 10, t) AS "end" FROM y WHERE least(n * 5.0::DOUBLE + 10, t) - n * 5.0::DOUBLE >= 1""")
def dedup_segments(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "audio_features", "audio_id", "duration_s").where("duration_s IS NOT NULL AND NOT isnan(duration_s)")
    return dedup.segments(f, "audio_id", F.col("duration_s"), 10.0, 0.5)


@query("SELECT user_id, event_id, r::INT AS r FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) r FROM events) WHERE r <= 3")
def newest_three(spark: SparkSession, d: str) -> DataFrame:
    r = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id")))
    return table(spark, d, "events", "user_id", "event_id", "ts").withColumn("r", r).where("r <= 3").select("user_id", "event_id", "r")


@query("SELECT event_id, strftime(ts, '%Y%m%d') || CASE WHEN r > 1 THEN '-' || lpad(CAST(r - 1 AS VARCHAR), 3, '0') ELSE '' END AS version FROM (SELECT event_id, ts, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) r FROM events)")
def version_names(spark: SparkSession, d: str) -> DataFrame:
    r = F.row_number().over(Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "event_id"))
    e = table(spark, d, "events", "event_id", "user_id", "ts").withColumn("r", r)
    return e.select("event_id", F.concat(F.date_format("ts", "yyyyMMdd"), F.when(F.col("r") > 1, F.concat(F.lit("-"), F.lpad((F.col("r") - 1).cast("string"), 3, "0"))).otherwise(F.lit(""))).alias("version"))


SLIDING = """
SELECT s AS start, s + INTERVAL 2 HOUR AS "end", event_type, count(*) AS n, round(sum(value), 4) AS total
FROM (SELECT event_type, value, time_bucket(INTERVAL 1 HOUR, ts) - k * INTERVAL 1 HOUR s FROM events, (SELECT unnest([0, 1]) k)) GROUP BY 1, 2, 3"""


@query(SLIDING)
def sliding_counts(spark: SparkSession, d: str) -> DataFrame:
    w = windows.sliding_counts(table(spark, d, "events", "ts", "event_type", "value"), "ts", "event_type", F.col("value"), "2 hours", "1 hour")
    return w.select("start", "end", "event_type", "n", F.round("total", 4).alias("total"))


@query(SLIDING)
def streamed_counts(spark: SparkSession, d: str) -> DataFrame:
    """The same windows from a stream of the files, run to its end."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    stream = windows.read_stream(spark, d, schema, pattern="events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    # the files are one burst; windows close once the watermark has passed them, and the last ones at the end of the input
    w = windows.sliding_counts(stream, "ts", "event_type", F.col("value"), "2 hours", "1 hour", late="1 hour")
    out = scratch(spark, "stream")
    windows.run_available(w, f"{out}/counts", f"{out}/checkpoint").awaitTermination()
    closed = spark.read.schema("start timestamp, end timestamp, event_type string, n bigint, total double").parquet(f"{out}/counts")
    # what the watermark hasn't passed yet is still open: those windows are counted from the table
    last = closed.agg(F.max("start").alias("s")).first()["s"]
    e = table(spark, d, "events", "ts", "event_type", "value")
    rest = windows.sliding_counts(e if last is None else e.where(F.col("ts").cast("timestamp") >= F.lit(last)), "ts", "event_type", F.col("value"), "2 hours", "1 hour")
    rest = rest.select(F.col("start").cast("timestamp").alias("start"), F.col("end").cast("timestamp").alias("end"), "event_type", "n", "total")
    both = closed.unionByName(rest if last is None else rest.where(F.col("start") > F.lit(last)))
    return both.select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""
WITH x AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 6 HOUR THEN 1 ELSE 0 END f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
y AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) g FROM x)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n FROM y GROUP BY user_id, g""")
def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    return windows.sessions(table(spark, d, "events", "user_id", "ts"), "ts", "user_id", "6 hours")


# duplicates and similarity


@query(f"""
WITH r AS (SELECT {HASH} h, audio_id, max(file_bytes) b FROM audio_manifest GROUP BY 1, 2), q AS (SELECT * FROM r WHERE h IS NOT NULL AND h <> '')
SELECT h AS hash, arg_min(audio_id, (-coalesce(b, -1), audio_id)) AS keep, count(*) AS n FROM q GROUP BY 1 HAVING count(*) > 1""")
def exact_groups(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "audio_manifest", "audio_id", "sha256", "file_bytes").withColumn("h", F.nullif(plain_hash(F.col("sha256")), F.lit("")))
    return dedup.exact_groups(m, "h", "audio_id", "file_bytes").select("hash", "keep", "n")


@query(f"""
WITH r AS (SELECT {HASH} h, audio_id, max(file_bytes) b FROM audio_manifest GROUP BY 1, 2), q AS (SELECT * FROM r WHERE h IS NOT NULL AND h <> ''),
k AS (SELECT h, arg_min(audio_id, (-coalesce(b, -1), audio_id)) keep FROM q GROUP BY 1)
SELECT q.audio_id AS remove, k.keep AS keep FROM q JOIN k USING (h) WHERE q.audio_id <> k.keep""")
def exact_links(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "audio_manifest", "audio_id", "sha256", "file_bytes").withColumn("h", F.nullif(plain_hash(F.col("sha256")), F.lit("")))
    return dedup.exact_links(m, "h", "audio_id", "file_bytes")


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) r FROM documents) WHERE r = 1 OR text IS NULL")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "lang", "text").select("doc_id", "lang", F.sha2("text", 256).alias("h"))
    return dedup.keep_first(docs, "h", [F.col("doc_id")]).select("doc_id", "lang")


VEC = "(SELECT vec_id, label, embedding::DOUBLE[] v FROM embeddings)"
#: A similarity that a fair part of the vectors have to some other.
NEAR = 0.3
PAIRS = f"SELECT a.vec_id x, b.vec_id y, a.label p, b.label q, round(list_cosine_similarity(a.v, b.v), 4) s FROM {VEC} a JOIN {VEC} b ON a.vec_id < b.vec_id AND list_cosine_similarity(a.v, b.v) >= {NEAR}"


@query(f"""
WITH p AS (SELECT a.vec_id x, b.vec_id y FROM {VEC} a JOIN {VEC} b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= {NEAR})
SELECT e.vec_id, count(p.y) AS links FROM embeddings e LEFT JOIN p ON e.vec_id = p.x GROUP BY 1""")
def similar_links(spark: SparkSession, d: str) -> DataFrame:
    """The number of similar vectors of each."""
    e = table(spark, d, "embeddings", "vec_id", "embedding")
    p = similarity.similar_pairs(e, "vec_id", "embedding", NEAR)
    n = p.select(F.explode(F.array("id_1", "id_2")).alias("vec_id")).groupBy("vec_id").agg(F.count("*").alias("links"))
    return e.select("vec_id").join(n, "vec_id", "left").select("vec_id", F.coalesce("links", F.lit(0)).alias("links"))


def _classes_sql(nodes: str, edges: str) -> str:
    """Components by least labels, handed on as often as a component can be long in the tables that SQL is run on."""
    return f"""e AS (SELECT x, y FROM ({edges}) UNION SELECT y, x FROM ({edges}) UNION SELECT id, id FROM ({nodes})),
l(x, y, n) AS (SELECT x, min(y), 0 FROM e GROUP BY 1 UNION ALL SELECT e.x, min(l.y), any_value(l.n) + 1 FROM e JOIN l ON e.y = l.x WHERE l.n < 40 GROUP BY 1),
c AS (SELECT x, min(y) y FROM l GROUP BY 1)"""


@query(f"WITH RECURSIVE p AS ({PAIRS}), {_classes_sql('SELECT vec_id id FROM embeddings', 'SELECT x, y FROM p')} SELECT x AS vec_id, y AS class_id FROM c")
def similar_classes(spark: SparkSession, d: str) -> DataFrame:
    """The class of each vector under similarity, its least id; those without a similar one are their own."""
    e = table(spark, d, "embeddings", "vec_id", "embedding")
    c = connected_components(similarity.similar_pairs(e, "vec_id", "embedding", NEAR), "id_1", "id_2").toDF("vec_id", "class")
    return e.select("vec_id").join(c, "vec_id", "left").select("vec_id", F.coalesce("class", "vec_id").alias("class_id"))


SPLIT_OF = "CASE label % 4 WHEN 0 THEN 'train' WHEN 1 THEN 'val' WHEN 2 THEN 'test' ELSE 'holdout_gold' END"


@query(f"""
WITH e AS (SELECT *, {SPLIT_OF} s, CASE label % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 4 END w FROM {VEC}),
p AS (SELECT CASE WHEN a.w >= b.w THEN a.s ELSE b.s END keep_in, CASE WHEN a.w >= b.w THEN b.s ELSE a.s END remove_from FROM e a JOIN e b ON a.vec_id < b.vec_id AND a.s <> b.s AND list_cosine_similarity(a.v, b.v) >= 0.25)
SELECT keep_in, remove_from, count(*) AS n FROM p GROUP BY 1, 2""")
def vector_leakage(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings", "vec_id", "embedding", "label").withColumn("split", F.expr(SPLIT_OF))
    p = similarity.similar_pairs(e, "vec_id", "embedding", 0.25, apart="split")
    return dedup.split_priority(p, e, "vec_id", "split").groupBy("keep_in", "remove_from").agg(F.count("*").alias("n"))


def _turns_sql(blocked_by: str) -> str:
    """Those that have their turn, taken in order: all but those blocked by one that had it."""
    return f"""i AS (SELECT id, row_number() OVER (ORDER BY id) r FROM (SELECT x id FROM p UNION SELECT y FROM p)), b AS ({blocked_by}),
t(r, l) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT i.r, CASE WHEN list_has_any(coalesce(b.l, []), t.l) THEN t.l ELSE list_append(t.l, i.id) END FROM t JOIN i ON i.r = t.r + 1 LEFT JOIN b ON b.id = i.id),
f AS (SELECT unnest(l) id FROM (SELECT l FROM t ORDER BY r DESC LIMIT 1))"""


@query(f"""
WITH RECURSIVE p AS ({PAIRS}), {_turns_sql("SELECT y id, list(x) l FROM p WHERE p >= q GROUP BY 1")},
m AS (SELECT p.* FROM p JOIN f ON p.x = f.id), k AS (SELECT y, min(x) a FROM m WHERE p >= q GROUP BY 1)
SELECT CASE WHEN m.p >= m.q THEN m.y ELSE m.x END AS remove, CASE WHEN m.p >= m.q THEN m.x ELSE m.y END AS keep, m.s AS similarity FROM m LEFT JOIN k ON m.y = k.y WHERE k.a IS NULL OR m.x <= k.a""")
def greedy_removals(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings", "vec_id", "embedding", "label")
    return dedup.greedy(cut(similarity.similar_pairs(e, "vec_id", "embedding", NEAR), "pairs"), e, "vec_id", ["label"])


@query(f"""
WITH RECURSIVE p AS ({PAIRS}), {_turns_sql("SELECT y id, list(x) l FROM p GROUP BY 1")},
g AS (SELECT y id, min(x) gid FROM p JOIN f ON p.x = f.id GROUP BY 1), m AS (SELECT gid, id FROM g UNION SELECT gid, gid FROM g),
k AS (SELECT m.gid, arg_min(m.id, (-e.label, m.id)) keep FROM m JOIN embeddings e ON e.vec_id = m.id GROUP BY 1)
SELECT m.gid AS group_id, m.id, k.keep, CASE WHEN m.id = k.keep THEN 1.0 ELSE p.s END AS similarity FROM m JOIN k ON m.gid = k.gid LEFT JOIN p ON p.x = least(m.id, k.keep) AND p.y = greatest(m.id, k.keep)""")
def star_groups(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings", "vec_id", "embedding", "label")
    return dedup.stars(cut(similarity.similar_pairs(e, "vec_id", "embedding", NEAR), "pairs"), e, "vec_id", "label")


@query(f"""
WITH d AS (SELECT q.vec_id query, e.vec_id id, round(1 - list_cosine_similarity(q.v, e.v), 9) d FROM {VEC} q JOIN {VEC} e ON q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY d, id) k FROM d) SELECT query, id, round(d, 6) AS distance, k::INT AS place FROM r WHERE k <= 5""")
def nearest_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Five nearest of every vector whose id is divisible by 20, among all."""
    e = table(spark, d, "embeddings", "vec_id", "embedding")
    n = similarity.top_neighbours(e, e.where("vec_id % 20 = 0"), "vec_id", "embedding", 5)
    return n.select("query", "id", F.round("distance", 6).alias("distance"), "place")


@query(f"""
WITH d AS (SELECT q.vec_id query, e.vec_id id, round(1 - list_cosine_similarity(q.v, e.v), 9) d FROM {VEC} q JOIN {VEC} e ON q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY d, id) k FROM d) SELECT round(quantile_cont(d, 0.75), 6) AS eps FROM r WHERE k = 5""")
def auto_eps(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings", "vec_id", "embedding")
    n = similarity.top_neighbours(e, e.where("vec_id % 20 = 0"), "vec_id", "embedding", 5)
    return density.kth_distance(n, 5).select(F.round("eps", 6).alias("eps"))


@query(f"SELECT vec_id, round(sqrt(list_sum([x * x for x in v])), 6) AS norm FROM {VEC}")
def vector_norms(spark: SparkSession, d: str) -> DataFrame:
    v = vectors.doubles(F.col("embedding"))
    return table(spark, d, "embeddings", "vec_id", "embedding").select("vec_id", F.round(vectors.norm(v), 6).alias("norm"))


CENTROIDS = f"c AS (SELECT label, list(m ORDER BY p) c FROM (SELECT label, p, avg(x) m FROM (SELECT label, unnest(v) x, generate_subscripts(v, 1) p FROM {VEC}) GROUP BY 1, 2) GROUP BY 1)"


@query(f"WITH {CENTROIDS} SELECT label, round(c[1], 6) AS first, round(list_sum(c), 6) AS total FROM c")
def cluster_centroids(spark: SparkSession, d: str) -> DataFrame:
    c = density.centroids(table(spark, d, "embeddings", "label", "embedding"), "label", "embedding")
    return c.select("label", F.round(F.get("centroid", 0), 6).alias("first"), F.round(F.aggregate("centroid", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@query(f"""
WITH {CENTROIDS}, x AS (SELECT e.label, list_distance(e.v, c.c) d FROM {VEC} e JOIN c USING (label))
SELECT label, count(*) AS size, round(count(*) / (SELECT count(*) FROM embeddings), 6) AS share, round(avg(d), 6) AS mean_distance, round(max(d), 6) AS max_distance FROM x GROUP BY 1""")
def cluster_summary(spark: SparkSession, d: str) -> DataFrame:
    s = density.summary(density.to_centroid(table(spark, d, "embeddings", "label", "embedding"), "label", "embedding"), "label")
    return s.select("label", "size", *[F.round(c, 6).alias(c) for c in ("share", "mean_distance", "max_distance")])


@query(f"""
WITH {CENTROIDS}, x AS (SELECT e.vec_id, e.label, min((list_distance(e.v, c.c), c.label)) b FROM {VEC} e, c GROUP BY 1, 2)
SELECT vec_id, b[2] AS nearest, round(b[1], 6) AS distance, CASE WHEN b[1] < 0.6 THEN 'substyle_variant' WHEN b[1] < 0.8 THEN 'substyle_outlier' WHEN label % 3 = 0 THEN 'non_music_outlier' ELSE 'extreme_style_variant' END AS grade FROM x""")
def outlier_grades(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings", "vec_id", "label", "embedding")
    # one centroid per label: as many as there are labels, which the clustering bounds
    c = {r["label"]: list(r["centroid"]) for r in density.centroids(e, "label", "embedding").collect()}
    n = similarity.nearest(e, "embedding", c)
    kind, _, _ = density.grade(F.col("distance"), F.col("label") % 3 != 0, F.lit(False), F.lit(False))
    return n.select("vec_id", "nearest", F.round("distance", 6).alias("distance"), kind.alias("grade"))


@query(f"""
WITH RECURSIVE p AS ({PAIRS}), d AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p), k AS (SELECT vec_id id FROM embeddings LEFT JOIN d ON d.x = vec_id GROUP BY 1 HAVING count(d.y) + 1 >= 5),
{_classes_sql("SELECT id FROM k", "SELECT x, y FROM p WHERE x IN (SELECT id FROM k) AND y IN (SELECT id FROM k)")},
o AS (SELECT d.x, min(c.y) y FROM d JOIN c ON d.y = c.x WHERE d.x NOT IN (SELECT id FROM k) GROUP BY 1), r AS (SELECT y, row_number() OVER (ORDER BY y) - 1 n FROM (SELECT DISTINCT y FROM c))
SELECT v.vec_id, coalesce(r.n, -1)::INT AS cluster FROM embeddings v LEFT JOIN (SELECT * FROM c UNION ALL SELECT * FROM o) z ON z.x = v.vec_id LEFT JOIN r ON r.y = z.y""")
def density_clusters(spark: SparkSession, d: str) -> DataFrame:
    return density.dbscan(table(spark, d, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", 1 - NEAR, 5)


@query(f"""
WITH a AS (SELECT label, vec_id % 7 k, p, avg(x) m FROM (SELECT label, vec_id, unnest(v) x, generate_subscripts(v, 1) p FROM {VEC}) GROUP BY 1, 2, 3), b AS (SELECT label, p, avg(m) m FROM a GROUP BY 1, 2)
SELECT label, round(sum(m), 6) AS total FROM b GROUP BY 1""")
def mean_pooled(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings", "vec_id", "label", "embedding").withColumn("part", F.col("vec_id") % 7)
    p = frames.mean_pool(e, ["label"], "embedding", "part")
    return p.select("label", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


# splits and their verification


def _ratio_sql(r: str, n: str) -> str:
    t = 1.01
    return f"CASE WHEN {r} <= floor({n} * ({0.8 / t!r}::DOUBLE)) THEN 'train' WHEN {r} <= floor({n} * ({0.8 / t!r}::DOUBLE)) + floor({n} * ({0.1 / t!r}::DOUBLE)) THEN 'val' WHEN {r} <= floor({n} * ({0.8 / t!r}::DOUBLE)) + 2 * floor({n} * ({0.1 / t!r}::DOUBLE)) THEN 'test' ELSE 'holdout_gold' END"


@query(f"SELECT o_orderkey, {_ratio_sql('r', 'n')} AS split FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate NULLS LAST, o_orderkey) r, count(*) OVER () n FROM orders)")
def temporal_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.temporal_split(table(spark, d, "orders", "o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey").select("o_orderkey", "split")


@query(f"SELECT o_orderkey, o_orderpriority, {_ratio_sql('r', 'n')} AS split FROM (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42|' || o_orderkey), o_orderkey) r, count(*) OVER (PARTITION BY o_orderpriority) n FROM orders)")
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.stratified_split(table(spark, d, "orders", "o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey")


@query(f"WITH g AS (SELECT o_custkey, {_ratio_sql('r', 'n')} s FROM (SELECT o_custkey, row_number() OVER (ORDER BY md5('42|' || o_custkey), o_custkey) r, count(*) OVER () n FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL))) SELECT o.o_custkey, o.o_orderkey, g.s AS split FROM orders o LEFT JOIN g ON o.o_custkey = g.o_custkey")
def isolated_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.isolated_split(table(spark, d, "orders", "o_custkey", "o_orderkey"), "o_custkey")


@query("SELECT o_orderkey, CASE WHEN r <= floor(n * 0.1::DOUBLE) THEN 'holdout_gold' WHEN r <= 2 * floor(n * 0.1::DOUBLE) THEN 'test' WHEN r <= 3 * floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) r, count(*) OVER () n FROM orders)")
def holdout_first_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.holdout_first_split(table(spark, d, "orders", "o_orderkey"), "o_orderkey")


@query("""
WITH s AS (SELECT DISTINCT audio_id, split_name split FROM split_ids WHERE audio_id IS NOT NULL), p AS (SELECT DISTINCT audio_id FROM audio_features WHERE audio_id IS NOT NULL)
SELECT audio_id, split FROM s WHERE split <> 'test' UNION ALL SELECT audio_id, 'train' FROM s WHERE split = 'test' AND audio_id NOT IN (SELECT audio_id FROM s WHERE split = 'train') UNION ALL SELECT audio_id, 'test' FROM p""")
def pool_replaced(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "split_ids", "audio_id", "split_name").where("audio_id IS NOT NULL").withColumnRenamed("split_name", "split").distinct()
    return splits.replace_from_pool(s, table(spark, d, "audio_features", "audio_id").where("audio_id IS NOT NULL").distinct(), "test", "audio_id")


@query("SELECT split_name, count(*) AS n, count(*) / (SELECT count(*) FROM split_ids) AS ratio FROM split_ids GROUP BY 1")
def split_statistics(spark: SparkSession, d: str) -> DataFrame:
    return splits.statistics(table(spark, d, "split_ids", "split_name"), "split_name")


@query("SELECT split_name, pool, count(*) AS n FROM split_ids GROUP BY 1, 2")
def split_strata(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "split_ids", "split_name", "pool").groupBy("split_name", "pool").agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT DISTINCT audio_id, split_name FROM split_ids WHERE audio_id IS NOT NULL AND split_name IS NOT NULL)
SELECT a.split_name AS "left", b.split_name AS "right", count(*) AS n FROM s a JOIN s b ON a.audio_id = b.audio_id AND a.split_name < b.split_name GROUP BY 1, 2""")
def split_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return splits.overlaps(table(spark, d, "split_ids", "audio_id", "split_name"), "audio_id", "split_name")


@query("""
WITH s AS (SELECT audio_id, split_name FROM split_ids WHERE audio_id IS NOT NULL), c(n, f) AS (
SELECT 'completeness', (SELECT coalesce(sum(k - 1), 0) FROM (SELECT count(*) k FROM s GROUP BY audio_id, split_name)) + (SELECT count(*) FROM (VALUES ('train'), ('val'), ('test'), ('holdout_gold')) v(x) WHERE x NOT IN (SELECT split_name FROM s WHERE split_name IS NOT NULL))
UNION ALL SELECT 'leakage', (SELECT count(*) FROM (SELECT audio_id FROM s GROUP BY 1 HAVING count(DISTINCT split_name) > 1))
UNION ALL SELECT 'existence', (SELECT count(DISTINCT audio_id) FROM s WHERE audio_id NOT IN (SELECT audio_id FROM audio_manifest WHERE audio_id IS NOT NULL))
UNION ALL SELECT 'checksum', (SELECT count(DISTINCT audio_id) FROM s WHERE audio_id NOT IN (SELECT audio_id FROM raw_audio_checksums WHERE audio_id IS NOT NULL)))
SELECT n AS "check", f::BIGINT AS failures, f = 0 AS passed FROM c UNION ALL SELECT 'overall', sum(f)::BIGINT, sum(f) = 0 FROM c""")
def split_verification(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "split_ids", "audio_id", "split_name")
    return splits.verify(s, table(spark, d, "audio_manifest", "audio_id"), table(spark, d, "raw_audio_checksums", "audio_id"), "audio_id", ["train", "val", "test", "holdout_gold"], "split_name")


# the whole chain


def curation(spark: SparkSession) -> Pipeline:
    """Documents: gate on length, one of equal texts, personal data redacted, split at random."""

    def gate(df: DataFrame, c: dict) -> Result:
        short = F.length(F.trim("text")) < c["least_chars"]
        df = df.withColumn("reason", F.when(F.col("text").isNull(), "no_text").when(short, "too_short"))
        return Result(df.where("reason IS NULL").drop("reason"), df.where("reason IS NOT NULL"))

    def exact(df: DataFrame, c: dict) -> Result:
        kept = dedup.keep_first(df.withColumn("h", F.sha2("text", 256)), "h", [F.col("doc_id")]).drop("h")
        return Result(kept)

    def redact(df: DataFrame, c: dict) -> Result:
        out, kinds = text.redact(df.select("doc_id", "source", "text"), "text")
        return Result(out.withColumn("removed", text.total({k: F.col(f"n_{k}") for k in kinds})).select("doc_id", "source", "text", "removed"))

    def split(df: DataFrame, c: dict) -> Result:
        return Result(splits.random_split(cut(df.select("doc_id", "source", "removed"), "clean"), "doc_id", seed=c["seed"]))

    return Pipeline([Stage("gate", gate), Stage("exact", exact), Stage("redact", redact), Stage("split", split)])


@query(f"""
WITH g AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND length(trim(text, ' ')) >= 20), k AS (SELECT min(doc_id) doc_id FROM g GROUP BY text),
r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) r, count(*) OVER () n FROM k)
SELECT {_ratio_sql('r', 'n')} AS split, count(*) AS n FROM r GROUP BY 1""")
def curated_documents(spark: SparkSession, d: str) -> DataFrame:
    run = curation(spark).run(spread(table(spark, d, "documents", "doc_id", "source", "text")), {"least_chars": 20, "seed": 7})
    return run.data.groupBy("split").agg(F.count("*").alias("n"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return curated_documents(spark, d)
