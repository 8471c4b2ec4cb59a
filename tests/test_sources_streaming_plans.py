"""Sources, sinks, streams and the pipeline."""

import importlib
import json

from pyspark.sql import functions as F

from millrace.plans import registry
from millrace.plans.pipeline import Pipeline, Result, Stage
from millrace.sources import files
from millrace.streaming import windows
from tests.conftest import rows


def test_text_sources(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("TRACK_ID\tARTIST_ID\tALBUM_ID\tPATH\tDURATION\tTAGS\nt1\ta1\tb1\tp\t12.5\tx\ty\nt2\ta\tb\tp\toops\nshort\tline\n")
    got = rows(files.read_ragged_tsv(spark, str(tmp_path / "m.tsv")))
    assert got == [("t1", "a1", "b1", "p", 12.5, "x y"), ("t2", "a", "b", "p", None, "")]
    (tmp_path / "r.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert rows(files.read_json_lines(spark, str(tmp_path / "r.jsonl"), "a int")) == [(1,), (2,)]
    (tmp_path / "l.txt").write_text("# note\n\nx, /a/b.wav\n/c/d.e.wav\n")
    assert rows(files.read_file_list(spark, str(tmp_path / "l.txt"))) == [("d.e", "/c/d.e.wav"), ("x", "/a/b.wav")]
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "one.json").write_text(json.dumps({"audio_id": "A", "x": 1}))
    (docs / "two.json").write_text(json.dumps({"x": 2}))
    (docs / "bad.json").write_text("{")
    assert rows(files.read_json_documents(spark, str(docs), "sample_id string, audio_id string, x int").select("item_id", "x")) == [("A", 1), ("two", 2)]
    assert files.read_csv(spark, str(tmp_path / "none.csv"), "a int", missing_ok=True).count() == 0
    assert files.first_existing(spark, str(tmp_path), ["zz", "l.txt", "m.tsv"]).endswith("l.txt")


def test_embeddings_and_inventory(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, float("nan"), None)], "audio_id string, dim_0 double, dim_1 double, dim_10 double")
    assert rows(files.embeddings(df)) == [("a", (1.0, 0.0, 0.0))]
    other = spark.createDataFrame([("a", 1.0, 5, 0.5)], "key string, rms double, bpm int, zcr double")
    assert rows(files.embeddings(other)) == [("a", (1.0, 0.5))]
    (tmp_path / "f.bin").write_bytes(b"abc")
    (tmp_path / "g.done").write_bytes(b"")
    inv = files.inventory(spark, str(tmp_path)).collect()
    assert len(inv) == 1 and inv[0]["size"] == 3 and inv[0]["sha256"].startswith("ba7816bf")
    for name in ("o.csv", "o.json", "o.parquet", "o"):
        p = files.write(df.select("audio_id"), str(tmp_path / name))
        assert p.endswith((".csv", ".json", ".parquet"))


def test_stream_equals_batch(spark, tmp_path):
    rows_in = [(i, f"2024-01-01 0{i % 5}:{i % 60:02}:00", "ab"[i % 2], float(i)) for i in range(200)]
    df = spark.createDataFrame(rows_in, "id int, t string, k string, v double").select("id", F.col("t").cast("timestamp").alias("ts"), "k", "v")
    for part in range(4):
        df.where(f"id % 4 = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    want = rows(windows.sliding_counts(df, "ts", "k", F.col("v"), "2 hours", "1 hour"))
    stream = windows.read_stream(spark, str(tmp_path / "in"), "id int, ts timestamp, k string, v double", 1)
    q = windows.sliding_counts(stream, "ts", "k", F.col("v"), "2 hours", "1 hour").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("w")) == want
    once = windows.first_seen(windows.read_stream(spark, str(tmp_path / "in"), "id int, ts timestamp, k string, v double"), ["k"], "ts", "1 day")
    windows.run_available(once, str(tmp_path / "once"), str(tmp_path / "cp1")).awaitTermination()
    assert {r["k"] for r in spark.read.parquet(str(tmp_path / "once")).collect()} == {"a", "b"}
    shape = "id int, ts timestamp, k string, v double"
    windows.upsert_sink(windows.read_stream(spark, str(tmp_path / "in"), shape, 1), str(tmp_path / "up"), "k", "v", str(tmp_path / "cp2"), buckets=4).awaitTermination()
    assert {(r["k"], r["v"]) for r in windows.read_upserted(spark, str(tmp_path / "up"), shape).collect()} == {("a", 198.0), ("b", 199.0)}
    assert windows.read_upserted(spark, str(tmp_path / "none"), shape).count() == 0


def test_sessions(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:20:00"), ("a", "2024-01-01 02:00:00")], "k string, t string").select("k", F.col("t").cast("timestamp").alias("t"))
    assert [r["n"] for r in windows.sessions(df, "t", "k", "30 minutes").orderBy("start").collect()] == [2, 1]


def test_pipeline(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, t string")
    gate = Stage("gate", lambda d, c: Result(d.where("t IS NOT NULL"), d.where("t IS NULL").withColumn("reason", F.lit("no_text"))))
    less = Stage("less", lambda d, c: d.where(F.col("id") < c["below"]))
    run = Pipeline([gate, less]).run(df, {"below": 3})
    assert rows(run.data) == [(1, "a")] and rows(run.rejects("id")) == [("gate", 2, "no_text")]
    doc = run.lineage("id")
    assert doc["counts"] == {"source": 3, "gate": 2, "less": 1} and doc["removed"] == {"gate": 1}
    assert rows(Pipeline([gate, less]).run(df, {"below": 3}, only=["less"]).data) == [(1, "a"), (2, None)]
    assert rows(Pipeline([gate, less]).run(df, {"below": 9}, start="less").data) == [(1, "a"), (2, None), (3, "b")]


def test_registry():
    assert set(registry.ORACLE) <= set(registry.QUERIES)
    entry = importlib.import_module("__spark_entry__")
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_versions(spark, tmp_path):
    from millrace.sources import versions

    root = str(tmp_path / "v")
    assert versions.registry(spark, root).count() == 0
    df = spark.createDataFrame([("a", "train"), ("b", "train"), ("c", "test")], "audio_id string, split string")
    first = versions.freeze(df, "audio_id", root, "20250101_000000", {"seed": 1})
    second = versions.freeze(df.where("split = 'train'"), "audio_id", root, "20250101_000000")
    assert (first, second) == ("v20250101_000000", "v20250101_000000-001")
    assert rows(versions.registry(spark, root).select("version", "total", "is_latest")) == [(first, 3, False), (second, 2, True)]
    assert rows(versions.load(spark, root)) == [("a", "train"), ("b", "train")]
    assert rows(versions.load(spark, root, first)) == [("a", "train"), ("b", "train"), ("c", "test")]


def test_kernels(spark):
    import pandas as pd

    from millrace.operators import kernels

    def load():
        def length(b):
            if (b["t"] == "bad").any():
                raise ValueError
            return pd.DataFrame({"n": b["t"].str.len()})

        return length

    def missing():
        raise ImportError("no such model")

    df = spark.createDataFrame([(1, "abc"), (2, "bad"), (3, "x")], "i int, t string")
    assert rows(kernels.apply_kernel(df, load, "n bigint", ["i"])) == [(1, 3, None), (2, None, "ValueError: "), (3, 1, None)]
    assert rows(kernels.apply_kernel(df.limit(1), [missing, load], "n bigint", ["i"])) == [(1, 3, None)]
    assert rows(kernels.apply_kernel(df.limit(0), load, "n bigint", ["i"])) == []
    cache = spark.createDataFrame([("abc", 99), ("zzz", 1)], "t string, n bigint")
    got, new = kernels.remembered(df.select("t"), cache, "t", lambda m: m.withColumn("n", F.length("t").cast("bigint")))
    assert rows(got) == [("abc", 99), ("bad", 3), ("x", 1)] and rows(new) == [("bad", 3), ("x", 1)]
