"""Queries of ingest records, batches, splits' isolation, retention and integrity, and the SQL that each is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import paths
from millrace.operators import dedup, ingest, ranking, retention, splits, tables
from millrace.plans.book import Book
from millrace.sources.tables import table
from millrace.streaming import windows

BOOK = Book()
query = BOOK.query


# ingest


@query(r"""
SELECT upper(i) AS audio_id, p AS file_relative_path, regexp_extract(p, '([^/\\]*)$', 1) AS original_filename, file_bytes, lower(regexp_extract(p, '\.([^.]*)$', 1)) AS format, 'active' AS status
FROM (SELECT 'in/x_' || audio_id || '.WAV' p, audio_id i, file_bytes FROM storage_checksums WHERE audio_id IS NOT NULL) WHERE regexp_full_match(upper(i), '[0-9A-HJKMNP-TV-Z]{26}')""")
def ingest_records(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "storage_checksums", "audio_id", "file_bytes", "sha256").where("audio_id IS NOT NULL").withColumn("path", F.concat(F.lit("in/x_"), "audio_id", F.lit(".WAV")))
    _, manifest = ingest.records(f, "path", "file_bytes", "sha256", F.lit("2025-01-01").cast("timestamp"))
    return manifest.select("audio_id", "file_relative_path", "original_filename", "file_bytes", "format", "status")


@query("SELECT audio_id, master_path, CASE WHEN duration_sec IS NULL OR isnan(duration_sec) THEN 0 ELSE duration_sec END AS duration_sec FROM audio_manifest WHERE trim(audio_id) <> '' AND trim(master_path) <> ''")
def manifest_items(spark: SparkSession, d: str) -> DataFrame:
    return ingest.manifest_items(table(spark, d, "audio_manifest", "audio_id", "master_path", "duration_sec"), "audio_id", "master_path", "duration_sec")


@query("SELECT track AS audio_id, track || '.mp3' AS original_filename, 'raw/set/' || track || '.mp3' AS file_relative_path, 'active' AS status, dur_s AS duration_seconds, 44100 AS sample_rate, 16 AS bit_depth, 2 AS channels, '' AS sha256 FROM dataset_joined")
def synthesised_manifest(spark: SparkSession, d: str) -> DataFrame:
    return ingest.synthesised(table(spark, d, "dataset_joined", "track", "dur_s"), "track", "dur_s", "raw/set/", "mp3", {"sample_rate": 44100, "bit_depth": 16, "channels": 2, "sha256": ""})


@query("""
SELECT audio_id, true AS found, min((audio_id, file_bytes))[2] AS file_bytes FROM audio_manifest WHERE audio_id IN (SELECT audio_id FROM split_ids WHERE split_name = 'test') GROUP BY 1
UNION ALL SELECT DISTINCT audio_id, false, NULL FROM split_ids WHERE split_name = 'test' AND audio_id IS NOT NULL AND audio_id NOT IN (SELECT audio_id FROM audio_manifest WHERE audio_id IS NOT NULL)""")
def batch_manifest(spark: SparkSession, d: str) -> DataFrame:
    """A batch of ids with the manifest's rows, and those that the manifest lacks."""
    ids = table(spark, d, "split_ids", "audio_id", "split_name").where("split_name = 'test'")
    there, gone = ingest.batch(ids, table(spark, d, "audio_manifest", "audio_id", "file_bytes"), "audio_id")
    return there.select("audio_id", F.lit(True).alias("found"), "file_bytes").unionByName(gone.select("audio_id", F.lit(False).alias("found"), F.lit(None).cast("bigint").alias("file_bytes")))


@query(r"""
WITH r AS (SELECT DISTINCT 'a/n_' || audio_id || '.wav' p, upper(audio_id) i FROM raw_audio_checksums WHERE audio_id IS NOT NULL),
d AS (SELECT DISTINCT upper(audio_id) i FROM split_ids WHERE split_name = 'train'), f AS (SELECT DISTINCT upper(audio_id) i FROM split_ids WHERE split_name = 'val')
SELECT r.p AS path, r.i AS audio_id, CASE WHEN r.i IN (SELECT i FROM f WHERE i IS NOT NULL) THEN 'failed' WHEN r.i IN (SELECT i FROM d WHERE i IS NOT NULL) THEN 'success' ELSE 'pending' END AS status FROM r""")
def denoise_states(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_audio_checksums", "audio_id").where("audio_id IS NOT NULL").select(F.concat(F.lit("a/n_"), "audio_id", F.lit(".wav")).alias("path")).distinct()
    s = table(spark, d, "split_ids", F.upper("audio_id").alias("audio_id"), "split_name")
    return ingest.denoise_status(r, "path", s.where("split_name = 'train'"), s.where("split_name = 'val'"))


@query("SELECT audio_id, true AS valid, floor(epoch_us(import_timestamp) / 1000)::BIGINT AS millis FROM audio_manifest WHERE import_timestamp IS NOT NULL")
def new_ids(spark: SparkSession, d: str) -> DataFrame:
    """Whether an id made from time and content is valid, and the time that it holds."""
    m = table(spark, d, "audio_manifest", "audio_id", "sha256", "import_timestamp").where("import_timestamp IS NOT NULL")
    m = m.withColumn("u", ingest.ulid(F.unix_millis(F.col("import_timestamp").cast("timestamp")), F.coalesce("sha256", F.lit(""))))
    time = F.lit(0).cast("bigint")
    for i in range(10):
        time = time * 32 + F.expr(f"instr('{ingest.ALPHABET}', substring(u, {i + 1}, 1)) - 1")
    return m.select("audio_id", paths.valid_id(F.col("u")).alias("valid"), time.cast("bigint").alias("millis"))


# joins and orders


@query("SELECT m.audio_id, f.audio_id AS feature_id, m.file_bytes, f.bpm FROM audio_manifest m JOIN audio_features f ON m.audio_id = f.audio_id")
def joined_features(spark: SparkSession, d: str) -> DataFrame:
    """An inner join under different names that keeps both keys."""
    f = table(spark, d, "audio_features", F.col("audio_id").alias("feature_id"), "bpm")
    m = table(spark, d, "audio_manifest", "audio_id", "file_bytes")
    return tables.inner(m, f, "audio_id", "feature_id")


@query("SELECT audio_id, sha256 FROM (SELECT m.audio_id, r.sha256, row_number() OVER (PARTITION BY r.sha256 ORDER BY m.audio_id, m.import_timestamp) k FROM (SELECT DISTINCT audio_id, import_timestamp FROM audio_manifest) m LEFT JOIN (SELECT audio_id, max(sha256) sha256 FROM raw_audio_checksums GROUP BY 1) r USING (audio_id)) WHERE k = 1 OR sha256 IS NULL")
def joined_then_unique(spark: SparkSession, d: str) -> DataFrame:
    """Checksums joined on, then one row per checksum."""
    m = table(spark, d, "audio_manifest", "audio_id", "import_timestamp").distinct()
    r = table(spark, d, "raw_audio_checksums", "audio_id", "sha256").groupBy("audio_id").agg(F.max("sha256").alias("sha256"))
    return dedup.keep_first(m.join(r, "audio_id", "left"), "sha256", [F.col("audio_id"), F.col("import_timestamp")]).select("audio_id", "sha256")


@query("SELECT audio_id, row_number() OVER (ORDER BY audio_id) AS rank FROM (SELECT DISTINCT audio_id FROM raw_audio_checksums WHERE audio_id IS NOT NULL)")
def sorted_ids(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_audio_checksums", "audio_id").where("audio_id IS NOT NULL").distinct()
    return ranking.global_rank(r, [F.col("audio_id")])


@query("SELECT DISTINCT audio_id FROM raw_audio_checksums WHERE audio_id IS NOT NULL ORDER BY 1 LIMIT 25")
def first_ids(spark: SparkSession, d: str) -> DataFrame:
    """The first 25 in order: a report."""
    return table(spark, d, "raw_audio_checksums", "audio_id").where("audio_id IS NOT NULL").distinct().orderBy("audio_id").limit(25)


@query("SELECT doc_id, text[:50] AS head, array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), '[A-Z][a-z]+')))[:3], '; ') AS examples FROM documents")
def short_examples(spark: SparkSession, d: str) -> DataFrame:
    """A report's form: the first fifty characters, and three examples of capitalised words."""
    docs = table(spark, d, "documents", "doc_id", "text")
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Z][a-z]+"), 0)
    return docs.select("doc_id", F.substring("text", 1, 50).alias("head"), F.array_join(F.slice(F.array_sort(F.array_distinct(found)), 1, 3), "; ").alias("examples"))


# near duplicates of parts

_SEGMENTS = "SELECT label item, vec_id n, embedding::DOUBLE[] v FROM embeddings"


@query(f"""
WITH s AS ({_SEGMENTS}) SELECT least(a.item, b.item) AS id_1, greatest(a.item, b.item) AS id_2, count(*) AS matching
FROM s a JOIN s b ON a.item < b.item AND list_cosine_similarity(a.v, b.v) >= 0.3 GROUP BY 1, 2""")
def segment_matches(spark: SparkSession, d: str) -> DataFrame:
    """Similar segments per pair of items: a label's vectors are taken as an item's segments."""
    e = table(spark, d, "embeddings", "label", "vec_id", "embedding")
    return dedup.segment_pairs(e, "label", "vec_id", "embedding", 0.3)[1]


# splits

_TIME_SPLIT = "CASE WHEN r <= floor(n * (0.7::DOUBLE)) THEN 'train' WHEN r <= floor(n * (0.7::DOUBLE)) + floor(n * (0.15::DOUBLE)) THEN 'val' ELSE 'test' END"


@query(f"""
WITH s AS (SELECT o_orderkey, {_TIME_SPLIT} split FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate NULLS LAST, o_orderkey) r, count(*) OVER () n FROM orders))
SELECT o_orderkey, split, row_number() OVER (PARTITION BY split ORDER BY md5('42|' || o_orderkey), o_orderkey) AS place FROM s""")
def temporal_shuffled(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    return splits.temporal_shuffled_split(o, "o_orderdate", "o_orderkey", {"train": 0.7, "val": 0.15, "test": 0.15}).select("o_orderkey", "split", "place")


@query("""
WITH s AS (SELECT DISTINCT s.split_name, m.import_timestamp b FROM split_ids s JOIN audio_manifest m USING (audio_id) WHERE m.import_timestamp IS NOT NULL), k AS (SELECT DISTINCT b FROM s WHERE split_name IN ('train', 'val'))
SELECT v.n AS split, count(DISTINCT s.b) FILTER (s.b IN (SELECT b FROM k)) AS shared, count(DISTINCT s.b) FILTER (s.b IN (SELECT b FROM k)) = 0 AS passed FROM (VALUES ('test'), ('holdout_gold')) v(n) LEFT JOIN s ON s.split_name = v.n GROUP BY 1""")
def batch_isolation(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "split_ids", "audio_id", "split_name")
    return splits.isolation(s, table(spark, d, "audio_manifest", "audio_id", "import_timestamp"), "audio_id", "import_timestamp", "split_name")


@query("""
WITH s AS (SELECT DISTINCT s.split_name, m.import_timestamp b FROM split_ids s JOIN audio_manifest m USING (audio_id) WHERE m.import_timestamp IS NOT NULL)
SELECT split_name AS split, b AS batch FROM s WHERE split_name IN ('test', 'holdout_gold') AND b IN (SELECT b FROM s WHERE split_name IN ('train', 'val'))""")
def shared_batches(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "split_ids", "audio_id", "split_name")
    return splits.shared_batches(s, table(spark, d, "audio_manifest", "audio_id", "import_timestamp"), "audio_id", "import_timestamp", "split_name")


@query("""
WITH s AS (SELECT DISTINCT audio_id, split_name split, list_position(['train', 'val', 'test', 'holdout_gold'], split_name) o FROM split_ids WHERE audio_id IS NOT NULL AND split_name IS NOT NULL)
SELECT split, count(*) AS n, count(*) FILTER (o > f) AS seen FROM (SELECT *, min(o) OVER (PARTITION BY audio_id) f FROM s) GROUP BY 1""")
def seen_before(spark: SparkSession, d: str) -> DataFrame:
    return splits.seen_before(table(spark, d, "split_ids", "audio_id", "split_name"), "audio_id", ["train", "val", "test", "holdout_gold"], "split_name")


@query("SELECT audio_id, array_to_string(list_sort(list(DISTINCT split_name)), ',') AS splits FROM split_ids WHERE audio_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT split_name) > 1")
def leaked_ids(spark: SparkSession, d: str) -> DataFrame:
    r = splits.require_apart(table(spark, d, "split_ids", "audio_id", "split_name"), "audio_id", "split_name", strict=False)
    return r.select("audio_id", F.array_join("splits", ",").alias("splits"))


# retention and integrity

NOW = "2026-09-01 12:00:00"


@query("""
SELECT audio_id, import_timestamp, CASE WHEN r <= 5 THEN 'keep' WHEN coalesce(status = 'active', false) THEN 'delete' ELSE 'skip' END AS action
FROM (SELECT audio_id, import_timestamp, status, audio_format, row_number() OVER (PARTITION BY audio_format ORDER BY import_timestamp DESC NULLS LAST, audio_id, status) r FROM (SELECT DISTINCT audio_id, import_timestamp, status, audio_format FROM audio_manifest))""")
def rotated(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "audio_manifest", "audio_id", "import_timestamp", "status", "audio_format").distinct()
    r = retention.rotate(m, ["audio_format"], [F.desc_nulls_last("import_timestamp"), F.col("audio_id"), F.col("status")], 5, F.col("status") == "active")
    return r.select("audio_id", "import_timestamp", "action")


@query(f"""
WITH a AS (SELECT audio_id, lower(audio_format) k, floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(import_timestamp)) / 86400000000)::BIGINT age, status FROM audio_manifest)
SELECT audio_id, age AS days, CASE WHEN NOT coalesce(age > CASE k WHEN 'wav' THEN 90 WHEN 'mp3' THEN 200 WHEN 'flac' THEN 30 END, false) THEN 'keep' WHEN status = 'active' OR k = 'mp3' THEN 'delete' ELSE 'skip' END AS action FROM a""")
def expired(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "audio_manifest", "audio_id", "audio_format", "import_timestamp", "status")
    m = m.withColumn("days", retention.age_in_days(F.col("import_timestamp"), F.lit(NOW)))
    return m.select("audio_id", "days", retention.expire(F.lower("audio_format"), F.col("days"), {"wav": 90, "mp3": 200, "flac": 30}, F.col("status") == "active", ["mp3"]).alias("action"))


@query("""
SELECT s_suppkey, round(p, 6) AS percent, CASE WHEN p >= 90 THEN 'critical' WHEN p >= 80 THEN 'warning' WHEN p IS NOT NULL THEN 'normal' END AS level
FROM (SELECT s_suppkey, (s_acctbal + 1000) / 11000 * 100 p FROM supplier)""")
def disk_levels(spark: SparkSession, d: str) -> DataFrame:
    percent, level = retention.disk_level(F.col("s_acctbal") + 1000, F.lit(11000))
    return table(spark, d, "supplier", "s_suppkey", "s_acctbal").select("s_suppkey", F.round(percent, 6).alias("percent"), level.alias("level"))


@query("""
WITH r AS (SELECT audio_id, max(file_bytes) a FROM raw_audio_checksums WHERE audio_id IS NOT NULL GROUP BY 1), s AS (SELECT audio_id k, max(file_bytes) b FROM storage_checksums GROUP BY 1),
j AS (SELECT substr(audio_id, 1, 4) g, k IS NOT NULL sent, a, b FROM r LEFT JOIN s ON audio_id = k)
SELECT g AS part, count(*) AS total, count(*) FILTER (NOT sent) AS failed, count(*) FILTER (sent AND a = b) AS verified, count(*) FILTER (NOT sent) = 0 AND count(*) FILTER (sent AND a = b) = count(*) AS complete FROM j GROUP BY 1""")
def transfer_verdicts(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_audio_checksums", "audio_id", "file_bytes").where("audio_id IS NOT NULL").groupBy("audio_id").agg(F.max("file_bytes").alias("a"))
    s = table(spark, d, "storage_checksums", F.col("audio_id").alias("k"), "file_bytes").groupBy("k").agg(F.max("file_bytes").alias("b"))
    j = r.join(s, r["audio_id"] == s["k"], "left").withColumn("part", F.substring("audio_id", 1, 4))
    return retention.transfer_verdict(j, "part", F.col("k").isNotNull(), F.col("a"), F.col("b"))


_INTEGRITY = """
WITH a AS (SELECT audio_id, max(sha256) a FROM raw_audio_checksums WHERE audio_id IS NOT NULL GROUP BY 1), b AS (SELECT audio_id k, max(sha256) b FROM storage_checksums WHERE audio_id IS NOT NULL GROUP BY 1),
s AS (SELECT audio_id, CASE WHEN k IS NULL THEN 'missing' WHEN a.a = b.b THEN 'verified' ELSE 'corrupted' END status FROM a LEFT JOIN b ON audio_id = k)"""


def _integrity(spark: SparkSession, d: str) -> DataFrame:
    side = lambda t: table(spark, d, t, "audio_id", "sha256").where("audio_id IS NOT NULL").groupBy("audio_id").agg(F.max("sha256").alias("sha256"))
    return retention.integrity(side("raw_audio_checksums"), side("storage_checksums"), "audio_id", "sha256")


@query(f"{_INTEGRITY} SELECT audio_id, status FROM s")
def baseline_integrity(spark: SparkSession, d: str) -> DataFrame:
    return _integrity(spark, d)


@query(f"{_INTEGRITY} SELECT s.audio_id, CASE WHEN s.audio_id IN (SELECT audio_id FROM audio_manifest WHERE audio_id IS NOT NULL) THEN 'backup' ELSE 'lost' END AS source FROM s WHERE status <> 'verified'")
def restore_list(spark: SparkSession, d: str) -> DataFrame:
    return retention.to_restore(_integrity(spark, d), table(spark, d, "audio_manifest", "audio_id"), "audio_id")


@query(r"""
SELECT doc_id::VARCHAR AS path, strlen(text) AS bytes, sha256(text) AS sha256, CASE WHEN starts_with(ltrim(text, ' '), '[') AND json_valid(text) THEN json_array_length(text::JSON)
  ELSE len(list_filter(regexp_split_to_array(text, '\r?\n'), lambda s: trim(s, ' ') <> '')) END::BIGINT AS annotations FROM documents WHERE text IS NOT NULL""")
def backup_counts(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", F.col("doc_id").cast("string").alias("path"), "text").where("text IS NOT NULL")
    return retention.annotation_counts(docs, "path", "text")


@query("""
WITH m AS (SELECT max(ts) m FROM events WHERE event_type <> 'error') SELECT event_id, ts < m - INTERVAL 2 DAY AS is_late FROM events, m WHERE event_type = 'error'""")
def late_events(spark: SparkSession, d: str) -> DataFrame:
    """Events of one type that come after all others: those in time, and those that are only reported."""
    e = table(spark, d, "events", "event_id", "event_type", "ts")
    fresh, late = windows.late_rows(e.where("event_type = 'error'"), e.where("event_type <> 'error'"), "ts", "2 DAYS")
    return fresh.select("event_id", F.lit(False).alias("is_late")).unionByName(late.select("event_id", F.lit(True).alias("is_late")))
