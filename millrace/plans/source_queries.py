"""Queries of sources and sinks: tables are written in a format and read again, and the SQL tells what must come back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import annotations, ingest, tables
from millrace.plans.book import Book
from millrace.plans.bundles import dedup_stages, write_bundle
from millrace.plans.pipeline import Pipeline
from millrace.runtime import scratch
from millrace.sources import files, versions
from millrace.sources.tables import table
from millrace.streaming import windows

BOOK = Book()
query = BOOK.query


def _folder(spark: SparkSession) -> str:
    return scratch(spark, "files")


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file with the given text."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(text.encode())
    out.close()


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_again(spark: SparkSession, d: str) -> DataFrame:
    path = files.write(table(spark, d, "customer", "c_custkey", "c_name", "c_acctbal"), f"{_folder(spark)}/t.csv")
    return files.read_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query("SELECT c_custkey, c_name FROM customer WHERE false")
def csv_absent(spark: SparkSession, d: str) -> DataFrame:
    return files.read_csv(spark, f"{_folder(spark)}/none.csv", "c_custkey bigint, c_name string", missing_ok=True)


@query("SELECT audio_id, status FROM audio_manifest WHERE status = 'active'")
def active_manifest(spark: SparkSession, d: str) -> DataFrame:
    path = files.write(table(spark, d, "audio_manifest", "audio_id", "status"), f"{_folder(spark)}/m.parquet")
    return files.active_manifest(spark.read.parquet(path))


@query("SELECT track_id AS TRACK_ID, coalesce(artist_id, '') AS ARTIST_ID, album_id AS ALBUM_ID, track AS PATH, duration AS DURATION, coalesce(replace(replace(replace(tags, chr(9), ' '), chr(10), ' '), chr(13), ' '), '') AS TAGS FROM dataset_joined WHERE track_id IS NOT NULL AND album_id IS NOT NULL AND track IS NOT NULL AND NOT contains(coalesce(artist_id, ''), chr(9))")
def ragged_tsv(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "dataset_joined", "track_id", "artist_id", "album_id", "track", "duration", "tags").where("track_id IS NOT NULL AND album_id IS NOT NULL AND track IS NOT NULL")
    t = t.where(~F.contains(F.coalesce("artist_id", F.lit("")), F.lit("\t")))
    cells = [F.col("track_id"), F.coalesce("artist_id", F.lit("")), F.col("album_id"), F.col("track"), F.coalesce(F.col("duration").cast("string"), F.lit("none")), F.regexp_replace(F.coalesce("tags", F.lit("")), r"[\n\r]", " ")]
    path = f"{_folder(spark)}/t.tsv"
    t.select(F.concat_ws("\t", *cells).alias("value")).write.text(path)
    return files.read_ragged_tsv(spark, path)


@query("SELECT event_id, user_id, value FROM events")
def json_lines(spark: SparkSession, d: str) -> DataFrame:
    """Records between blank and broken lines."""
    path, schema = f"{_folder(spark)}/l.jsonl", "event_id bigint, user_id bigint, value double"
    rows = table(spark, d, "events", "event_id", "user_id", "value").select(F.to_json(F.struct("*")).alias("value"))
    rows.withColumn("value", F.explode(F.array("value", F.lit(" "), F.concat(F.lit("{"), "value")))).write.text(path)
    return files.read_json_lines(spark, path, schema)


@query("SELECT CASE WHEN n_nationkey % 3 = 0 THEN 'n' || n_nationkey ELSE 'file_' || n_nationkey END AS item_id, n_name AS name FROM nation")
def json_folder(spark: SparkSession, d: str) -> DataFrame:
    """One file per record; every third tells its id, one is broken."""
    import json

    folder = _folder(spark)
    for r in table(spark, d, "nation", "n_nationkey", "n_name").collect():  # 25 rows
        k = r["n_nationkey"]
        _put(spark, f"{folder}/file_{k}.json", json.dumps({"name": r["n_name"]} | ({"audio_id": f"n{k}"} if k % 3 == 0 else {})))
    _put(spark, f"{folder}/broken.json", "{")
    return files.read_json_documents(spark, folder, "sample_id string, audio_id string, name string").select("item_id", "name")


@query("""
SELECT coalesce(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, 'f' || s_suppkey) AS item_id, '/in/f' || s_suppkey || '.wav' AS path FROM supplier""")
def file_list(spark: SparkSession, d: str) -> DataFrame:
    """Lines "id,path" and bare paths, between comments and blank lines."""
    path = f"{_folder(spark)}/list.txt"
    p = F.concat(F.lit("/in/f"), "s_suppkey", F.lit(".wav"))
    line = F.when(F.col("s_suppkey") % 2 == 0, F.concat("s_name", F.lit(", "), p)).otherwise(p)
    table(spark, d, "supplier", "s_suppkey", "s_name").select(F.explode(F.array(line, F.lit("# note"), F.lit(" "))).alias("value")).write.text(path)
    return files.read_file_list(spark, path)


@query("SELECT 'f' || s_suppkey AS item_id, '/in/f' || s_suppkey || '.wav' AS path FROM supplier")
def first_column_list(spark: SparkSession, d: str) -> DataFrame:
    """A table whose first column holds paths: ids are the files' stems."""
    path = f"{_folder(spark)}/t.csv"
    t = table(spark, d, "supplier", "s_suppkey", "s_name").select(F.concat(F.lit("/in/f"), "s_suppkey", F.lit(".wav")).alias("file"), "s_name")
    return files.input_list(spark.read.option("header", True).csv(files.write(t, path)))


@query("SELECT vec_id::VARCHAR AS id, round(list_sum(embedding::DOUBLE[]), 6) AS total, len(embedding)::INT AS dims FROM embeddings")
def wide_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """Vectors spread over columns, written, found by their names and read as vectors again."""
    e = table(spark, d, "embeddings", "vec_id", "label", "embedding")
    n = 64
    wide = e.select(F.col("vec_id").cast("string").alias("track_id"), F.col("label").cast("double").alias("bpm"), *[F.get("embedding", i).alias(f"dim_{i}") for i in range(n)])
    folder = _folder(spark)
    files.write(wide, f"{folder}/mert.parquet")
    found = files.first_existing(spark, folder, ["clap.parquet", "mert.parquet"])
    v = files.embeddings(spark.read.parquet(found))
    return v.select("id", F.round(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x), 6).alias("total"), F.size("vector").alias("dims"))


@query("SELECT n_nationkey::INT AS n, strlen(n_name)::BIGINT AS size, sha256(n_name) AS sha256, md5(n_name) AS md5 FROM nation")
def file_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Files below a folder with size and checksums; markers and other kinds are left out."""
    folder = _folder(spark)
    for r in table(spark, d, "nation", "n_nationkey", "n_name").collect():  # 25 rows
        _put(spark, f"{folder}/{r['n_nationkey'] % 4}/f{r['n_nationkey']}.wav", r["n_name"])
    _put(spark, f"{folder}/0/x.done", "x"), _put(spark, f"{folder}/0/x.txt", "x")
    i = files.inventory(spark, folder, extensions=("wav", "flac"), md5=True)
    return i.select(F.regexp_extract("path", r"f(\d+)\.wav$", 1).cast("int").alias("n"), "size", "sha256", "md5")


@query("SELECT n_nationkey::INT AS n, 8000 + n_nationkey::INT * 100 AS sample_rate, 1 + n_nationkey::INT % 2 AS channels, 16 AS bits, n_nationkey / 10 AS seconds, false AS corrupted FROM nation UNION ALL SELECT -1, NULL, NULL, NULL, NULL, true")
def media_headers(spark: SparkSession, d: str) -> DataFrame:
    """Wave files of known form, and a broken one."""
    import struct

    def wave(rate: int, channels: int, seconds: float) -> bytearray:
        size = round(seconds * rate) * channels * 2
        return bytearray(b"RIFF" + struct.pack("<I", 36 + size) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, channels, rate, rate * channels * 2, channels * 2, 16) + b"data" + struct.pack("<I", size))

    rows = [(k, wave(8000 + k * 100, 1 + k % 2, k / 10)) for k in range(25)] + [(-1, bytearray(b"RIFF"))]
    return ingest.probe(spark.createDataFrame(rows, "n int, content binary"), "n", "content")


@query("SELECT 'piano' AS name, 0 AS program UNION ALL SELECT 'kalimba', 108")
def tag_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """A vocabulary from a JSON document."""
    path = f"{_folder(spark)}/dictionary.json"
    _put(spark, path, '{"instrument_gm128_map": {"piano": 0, "kalimba": 108}, "blacklist_tags": ["bad audio"]}')
    return spark.createDataFrame(list(files.read_dictionary(spark, path).instruments.items()), "name string, program int")


@query("SELECT audio_id, max((import_timestamp, file_bytes))[2] AS file_bytes FROM raw_audio_checksums WHERE audio_id IS NOT NULL AND import_timestamp IS NOT NULL AND file_bytes IS NOT NULL GROUP BY 1")
def streamed_upserts(spark: SparkSession, d: str) -> DataFrame:
    """One row per key from a stream of files, the last by time."""
    folder, shape = _folder(spark), "audio_id string, import_timestamp timestamp, file_bytes bigint"
    rows = table(spark, d, "raw_audio_checksums", "audio_id", F.col("import_timestamp").cast("timestamp").alias("import_timestamp"), "file_bytes").na.drop()
    rows.repartition(3).write.parquet(f"{folder}/in")
    stream = windows.read_stream(spark, f"{folder}/in", shape, files_per_trigger=1)
    windows.upsert_sink(stream, f"{folder}/out", "audio_id", "import_timestamp", f"{folder}/cp", buckets=8).awaitTermination()
    return windows.read_upserted(spark, f"{folder}/out", shape).select("audio_id", "file_bytes")


@query("SELECT split_name AS split, count(DISTINCT audio_id) AS n FROM split_ids WHERE audio_id IS NOT NULL AND split_name IN ('train', 'val', 'test') GROUP BY 1")
def frozen_version(spark: SparkSession, d: str) -> DataFrame:
    """Splits frozen twice, and the latest version read again."""
    folder = _folder(spark)
    s = table(spark, d, "split_ids", "audio_id", F.col("split_name").alias("split")).where("audio_id IS NOT NULL").distinct()
    versions.freeze(s, "audio_id", folder, "20260101_000000", {"seed": 42})
    versions.freeze(s.where("split <> 'holdout_gold'"), "audio_id", folder, "20260101_000000")
    return versions.load(spark, folder).groupBy("split").agg(F.count("*").alias("n"))


@query("""
WITH a AS (SELECT DISTINCT vec_id, label FROM embeddings), k AS (SELECT min(vec_id) v FROM a GROUP BY label)
SELECT 'source' AS stage, count(*) AS n FROM a UNION ALL SELECT 'exact', count(*) FROM k""")
def dedup_run(spark: SparkSession, d: str) -> DataFrame:
    """The exact stage of the staged removal, written as a bundle under a version and read again."""
    e = table(spark, d, "embeddings", "vec_id", "label").withColumn("size", F.lit(1)).distinct().withColumn("hash", F.col("label").cast("string"))
    stages = dedup_stages("vec_id", "hash", "size", lambda df: None, ["size"])
    run = Pipeline(stages).run(e, only=["exact"])
    paths = write_bundle(run, "vec_id", _folder(spark), "v1")
    return spark.read.parquet(paths["counts"]).select("stage", "n")


# nested records

_LINE = """'{"id": "' || n_nationkey || '", "data": {"audio": "p' || n_nationkey || '"}, "annotations": [{"result": [{"from_name": "mood", "value": {"choices": ["' || n_name || '", "x"]}}, {"from_name": "note", "value": {"text": ["t' || n_regionkey || '"]}}]}]}'"""


@query("SELECT n_nationkey::VARCHAR AS id, 'p' || n_nationkey AS audio, n_name AS mood, 't' || n_regionkey AS note, '' AS genre FROM nation")
def annotation_answers(spark: SparkSession, d: str) -> DataFrame:
    """First answers of nested annotation records; an absent one is empty."""
    lines = table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey").select(F.from_json(F.expr(_LINE), annotations.ANNOTATION).alias("r")).select("r.*")
    return annotations.flatten(lines, ["mood", "genre"], ["note"]).drop("raw")


@query("SELECT 'n' || n_nationkey AS id, 'http://host/f' || n_nationkey || '.wav' AS audio, CASE WHEN n_nationkey % 2 = 0 THEN n_name || ', drums' ELSE '' END AS instruments, 'calm' AS mood, '' AS genre, n_nationkey * 1.5 AS tempo, NULL::VARCHAR AS key FROM nation")
def label_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Labelling tasks of inference records, with missing lists empty."""
    n = table(spark, d, "nation", "n_nationkey", "n_name")
    lists = F.when(F.col("n_nationkey") % 2 == 0, F.array("n_name", F.lit("drums")))
    p = F.struct(lists.alias("instruments"), F.array(F.lit("calm")).alias("mood"), F.lit(None).cast("array<string>").alias("genre"), (F.col("n_nationkey") * 1.5).alias("tempo"), F.lit(None).cast("string").alias("key"))
    rows = n.select(F.concat(F.lit("n"), "n_nationkey").alias("item_id"), F.concat(F.lit("f"), "n_nationkey", F.lit(".wav")).alias("audio_path"), p.alias("predictions"))
    return annotations.tasks(rows, "http://host/")


@query("SELECT DISTINCT user_id FROM events")
def first_seen_keys(spark: SparkSession, d: str) -> DataFrame:
    """The keys of a stream, each once."""
    folder = _folder(spark)
    table(spark, d, "events", "user_id", F.col("ts").cast("timestamp").alias("ts")).repartition(3).write.parquet(f"{folder}/in")
    stream = windows.read_stream(spark, f"{folder}/in", "user_id bigint, ts timestamp", files_per_trigger=1)
    windows.run_available(windows.first_seen(stream, ["user_id"], "ts", "400 days"), f"{folder}/out", f"{folder}/cp").awaitTermination()
    return spark.read.schema("user_id bigint").parquet(f"{folder}/out")


@query("""
WITH a AS (SELECT file_relative_path p, max(file_bytes) s, max(sha256) c FROM raw_audio_checksums WHERE file_relative_path IS NOT NULL GROUP BY 1),
b AS (SELECT file_relative_path p, max(file_bytes) s, max(sha256) c FROM storage_checksums WHERE file_relative_path IS NOT NULL GROUP BY 1)
SELECT coalesce(a.p, b.p) AS file_relative_path, CASE WHEN b.p IS NULL THEN 'missing' WHEN a.p IS NULL THEN 'extra' WHEN a.s IS DISTINCT FROM b.s THEN 'size_mismatch' WHEN a.c <> b.c AND NOT contains(b.c, 'a0') THEN 'checksum_mismatch' ELSE 'ok' END AS status FROM a FULL JOIN b ON a.p = b.p""")
def store_diff(spark: SparkSession, d: str) -> DataFrame:
    """An inventory compared with a store's, whose checksums of one kind aren't comparable."""
    side = lambda t: table(spark, d, t, "file_relative_path", "file_bytes", "sha256").where("file_relative_path IS NOT NULL").groupBy("file_relative_path").agg(F.max("file_bytes").alias("file_bytes"), F.max("sha256").alias("sha256"))
    return tables.inventory_diff(side("raw_audio_checksums"), side("storage_checksums"), "file_relative_path", "file_bytes", "sha256", skip=F.contains(F.col("b"), F.lit("a0")))
