"""Sliding windows and blocks of items: generated from each row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sliding_chunks(df: DataFrame, key: str, total: Column, size: float = 30.0, overlap: float = 0.5, least: float = 5.0) -> DataFrame:
    """``(chunk_id, key, n, start_time, end_time, duration)``: windows of ``size``, ``size * (1 - overlap)`` apart.

    Windows begin before the end and are cut at it; one shorter than ``least`` ends the row of windows, unless it is the
    first. An item shorter than ``least``, or of null or NaN length, has none. Times have three places.
    """
    if not 0 <= overlap < 1 or size <= 0 or least <= 0:
        raise ValueError("0 <= overlap < 1, and size and least above 0, are needed")
    hop = size * (1 - overlap)
    rows = df.select(F.col(key), total.cast("double").alias("_t")).where(~F.isnan("_t") & (F.col("_t") >= least) & (F.col("_t") < 1e15))
    n = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("_t") / F.lit(hop)).cast("int") - 1))).alias("n")
    rows = rows.select(key, "_t", n)
    start = F.col("n") * F.lit(hop)
    end = F.least(start + F.lit(float(size)), F.col("_t"))
    rows = rows.withColumn("_s", start).withColumn("_e", end).where((F.col("_s") < F.col("_t")) & ((F.col("_e") - F.col("_s") >= least) | (F.col("n") == 0)))
    return rows.select(
        F.concat(F.col(key), F.lit("_chunk"), F.lpad(F.col("n").cast("string"), 4, "0")).alias("chunk_id"), key, "n",
        F.round("_s", 3).alias("start_time"), F.round("_e", 3).alias("end_time"), F.round(F.col("_e") - F.col("_s"), 3).alias("duration"),
    )


def blocks(df: DataFrame, key: str, total: Column, size: float = 30.0) -> DataFrame:
    """``(key, n, start, end)``: blocks side by side, the last one kept however short; no length, no block."""
    rows = df.select(F.col(key), total.cast("double").alias("_t")).where(~F.isnan("_t") & (F.col("_t") > 0) & (F.col("_t") < 1e15))
    rows = rows.select(key, "_t", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_t") / F.lit(size)).cast("int") - 1)).alias("n"))
    return rows.select(key, "n", (F.col("n") * F.lit(size)).alias("start"), F.least((F.col("n") + 1) * F.lit(size), F.col("_t")).alias("end"))
