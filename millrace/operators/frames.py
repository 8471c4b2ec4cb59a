"""Frames of items reduced to items: tag shares, top tags, interval and pitch statistics, pooled vectors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.vectors import doubles

# fixed values: the tags that count as music, speech, singing, noise and silence
TAG_SETS: Mapping[str, tuple[str, ...]] = {
    "music": (
        "Music", "Musical instrument", "Singing", "Male singing", "Female singing", "Choir", "Orchestra", "Piano", "Guitar", "Drum",
        "Bass guitar", "Synthesizer", "Pop music", "Rock music", "Hip hop music", "Electronic music", "Jazz", "Classical music",
        "Country music", "Reggae", "Blues", "R&B", "Folk music", "World music", "Latin music", "Funk", "Disco", "Techno",
        "House music", "Trance", "Dubstep", "Ambient music", "New age music", "Vocalization", "Hum", "Beatboxing", "Rapping",
    ),
    "speech": (
        "Speech", "Conversation", "Narration, monologue", "Babble", "Speech synthesizer", "Shout", "Bellow", "Whoop", "Yell",
        "Children shouting", "Woman speech", "Man speech", "Child speech", "Infant cry", "Cough", "Sneeze", "Throat clearing",
    ),
    "vocals": ("Singing", "Male singing", "Female singing", "Choir", "Vocalization", "Hum", "Beatboxing", "Rapping"),
    "noise": (
        "Environmental noise", "White noise", "Pink noise", "Throbbing", "Static", "Distortion", "Sound effect", "Traffic noise",
        "Aircraft noise", "Engine noise", "Wind noise", "Rain", "Thunder", "Water", "Waves", "Bird", "Insect", "Dog", "Cat",
        "Horse", "Cow", "Frog", "Cricket",
    ),
    "silence": ("Silence",),
}
LIMITS = {"music": 0.30, "speech": 0.05, "vocals": 0.05, "noise": 0.05, "silence": 0.15}
NAMES = {"music": "is_music", "speech": "has_speech", "vocals": "has_vocals", "noise": "has_noise", "silence": "has_silence"}


def frame_to_item(df: DataFrame, item: str, name: str, confidence: Column, threshold: float = 0.3, sets: Mapping[str, tuple[str, ...]] = TAG_SETS, limits: Mapping[str, float] = LIMITS) -> DataFrame:
    """Per item the share of each tag set among its frames above the threshold, verdicts, and frame numbers.

    An item without any such frame is judged by all its frames. A null confidence is below the threshold, a null name in
    no set. One aggregation holds both cases, so that items with very many frames are folded on the map side.
    """
    good = F.coalesce(confidence > threshold, F.lit(False))
    hit = {k: F.coalesce(F.col(name).isin(*v), F.lit(False)) for k, v in sets.items()}
    sums = [F.count_if(good & h).alias(f"g_{k}") for k, h in hit.items()] + [F.count_if(h).alias(f"a_{k}") for k, h in hit.items()]
    g = df.groupBy(item).agg(F.count("*").alias("total_frames"), F.count_if(good).alias("n_good"), *sums)
    n = F.when(F.col("n_good") > 0, F.col("n_good")).otherwise(F.col("total_frames"))
    share = {k: F.when(F.col("n_good") > 0, F.col(f"g_{k}")).otherwise(F.col(f"a_{k}")) / n for k in sets}
    return g.select(
        item, *[(share[k] > limits[k]).alias(NAMES.get(k, f"has_{k}")) for k in sets], *[share[k].alias(f"{k}_ratio") for k in sets],
        "total_frames", n.alias("high_confidence_frames"),
    )


def top_tags(df: DataFrame, item: str, name: str, order: str, k: int = 5) -> DataFrame:
    """``(item, top)`` as "name:count; ...": the k most frequent names of each item, ties by their first place in ``order``.

    Counts are folded per item and name first; what is ranked is at most one row per name of an item.
    """
    c = df.select(F.col(item).alias("_k"), F.col(name).alias("_name"), F.col(order).alias("_o")).where("_name IS NOT NULL")
    c = c.groupBy("_k", "_name").agg(F.count("*").alias("_n"), F.min("_o").alias("_first"))
    c = c.withColumn("_r", F.row_number().over(Window.partitionBy("_k").orderBy(F.desc("_n"), "_first", "_name"))).where(F.col("_r") <= k)
    text = F.concat(F.col("_name"), F.lit(":"), F.col("_n").cast("string"))
    top = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_r").alias("r"), text.alias("t")))), lambda s: s["t"]), "; ")
    return c.groupBy(F.col("_k").alias(item)).agg(top.alias("top"))


def interval_stats(df: DataFrame, item: str, time: Column, bucket_seconds: float = 86400.0) -> DataFrame:
    """Statistics of the distances between successive times of an item: count, mean, population deviation, least, greatest.

    ``n`` counts times, of which the first and last are given; fewer than two leave the statistics null. Times are
    ordered within buckets of a fixed width, and the last time of the bucket before is carried over, so that no item
    with very many times forms one group.
    """
    rows = df.select(F.col(item).alias("k"), time.alias("t")).where("t IS NOT NULL").withColumn("b", F.floor(F.col("t") / F.lit(bucket_seconds)))
    rows = rows.withColumn("prev", F.lag("t").over(Window.partitionBy("k", "b").orderBy("t")))
    ends = rows.groupBy("k", "b").agg(F.max("t").alias("end"))
    ends = ends.select(F.col("k").alias("ck"), F.col("b").alias("cb"), F.lag("end").over(Window.partitionBy("k").orderBy("b")).alias("carry"))
    rows = rows.join(ends, F.expr("k <=> ck AND b = cb")).withColumn("d", F.col("t") - F.coalesce("prev", "carry"))
    return rows.groupBy(F.col("k").alias(item)).agg(
        F.count("*").alias("n"), F.avg("d").alias("mean"), F.stddev_pop("d").alias("std"), F.min("d").alias("min"), F.max("d").alias("max"),
        F.min("t").alias("first"), F.max("t").alias("last"),
    )


def series_stats(df: DataFrame, item: str, value: Column, confidence: Column, shares: Mapping[str, float] = {"high": 0.5, "voiced": 0.3}) -> DataFrame:
    """Mean, population deviation, least, greatest and median of a series, and the share of frames above confidences."""
    ok = F.when(~F.isnan(value), value)
    return df.groupBy(item).agg(
        F.count("*").alias("n"), F.avg(ok).alias("mean"), F.stddev_pop(ok).alias("std"), F.min(ok).alias("min"), F.max(ok).alias("max"), F.median(ok).alias("median"),
        F.avg(confidence).alias("mean_confidence"), *[F.avg(F.coalesce(confidence > t, F.lit(False)).cast("double")).alias(f"{k}_share") for k, t in shares.items()],
    )


def mean_pool(df: DataFrame, group: list[str], vector: str, chunk: str | None = None) -> DataFrame:
    """The mean vector of each group; with ``chunk`` the unweighted mean of the means of its chunks."""
    keys = [*group, chunk] if chunk else group
    long = df.select(*keys, F.posexplode(doubles(F.col(vector))).alias("pos", "x")).groupBy(*keys, "pos").agg(F.avg("x").alias("x"))
    if chunk:
        long = long.groupBy(*group, "pos").agg(F.avg("x").alias("x"))
    return long.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias(vector))
