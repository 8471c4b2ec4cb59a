"""The batch operators' windows, deduplication and upserts on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Columns of the folders below an upserted table.
BUCKET, BATCH = "bucket_", "batch_"


def read_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 16, pattern: str = "*.parquet") -> DataFrame:
    """A stream of the Parquet files of a folder, so many at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", pattern).parquet(folder)


def sliding_counts(df: DataFrame, time: str, by: str, value: Column, size: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """``(start, end, by, n, total)`` of event-time windows; ``late`` bounds the state a stream keeps. Batch or stream."""
    if late:
        df = df.withWatermark(time, late)
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return df.groupBy(w.alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n", "total")


def sessions(df: DataFrame, time: str, by: str, gap: str, late: str | None = None) -> DataFrame:
    """``(by, start, end, n)``: events of one key less than ``gap`` apart form a session. Batch or stream."""
    if late:
        df = df.withWatermark(time, late)
    return df.groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("n")).select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(df: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """The first row of each key; a key is forgotten once the watermark has passed it."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def upsert_sink(df: DataFrame, path: str, key: str, order: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Keeps one row per key, the last by ``order``, below ``path``, in buckets by a hash of the key; runs on what is there and ends.

    A micro-batch rewrites only the buckets that its keys fall in: bucket b of batch n goes to ``path/bucket_=<b>/batch_=<n>``, made
    from the bucket's last version below n, so that a batch run again after a failure writes the same files. ``read_upserted`` reads
    the last version of each bucket.
    """
    from millrace.operators.tables import upsert_last

    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        asked = [r[0] for r in batch.select(bucket.alias(BUCKET)).distinct().collect()]  # at most ``buckets``
        last = {b: v for b, v in _versions(spark, path, n).items() if b in asked}
        every = batch.withColumn(BUCKET, bucket)
        if last:
            old = spark.read.schema(batch.schema).parquet(*[f"{path}/{BUCKET}={b}/{BATCH}={v}" for b, v in last.items()]).withColumn(BUCKET, bucket)
            every = old.unionByName(every)
        out = upsert_last([every], key, [order]).withColumn(BATCH, F.lit(n))
        out.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH).parquet(path)

    return df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, path: str, below: int | None = None) -> dict[int, int]:
    """The last version of each bucket, of those below a number."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[int, int] = {}
    for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET}=*/{BATCH}=*")) or []:
        b, v = (int(p.split("=")[1]) for p in s.getPath().toString().rsplit("/", 2)[-2:])
        if below is None or v < below:
            out[b] = max(out.get(b, -1), v)
    return out


def read_upserted(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows that ``upsert_sink`` has kept."""
    last = _versions(spark, path)
    return spark.read.schema(schema).parquet(*[f"{path}/{BUCKET}={b}/{BATCH}={v}" for b, v in last.items()]) if last else spark.createDataFrame([], schema)


def late_rows(df: DataFrame, seen: DataFrame, time: str, late: str) -> tuple[DataFrame, DataFrame]:
    """(in time, late) rows of a batch: late is what lies more than ``late`` before the latest time of what has been ``seen``.

    Late rows are a side output, to be reported and not merged; null times are late. Before anything has been seen nothing is.
    """
    mark = seen.agg((F.max(time) - F.expr(f"INTERVAL {late}")).alias("m")).first()["m"]
    fresh = F.coalesce(F.col(time) >= F.lit(mark), F.lit(False)) if mark is not None else F.lit(True)
    return df.where(fresh), df.where(~fresh)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Writes a stream as Parquet from what is there now, and ends; the checkpoint skips what earlier runs have read."""
    return df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def each_new(df: DataFrame, checkpoint: str, act: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """``act`` on every new batch, once per batch number."""
    return df.writeStream.foreachBatch(act).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
