"""What may be deleted, what has to be restored, and whether a copy is sound: decisions as columns, nothing is deleted here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rotate(df: DataFrame, group: Sequence[str], order: Sequence[Column], keep: int, verified: Column) -> DataFrame:
    """Adds ``action``: "keep" for the first ``keep`` rows of each group in ``order``, of the rest "delete" where they are
    verified, else "skip". A null verdict isn't one.

    A group is the snapshots of one folder, or the like: it is ranked in one task.
    """
    r = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_r", r).withColumn("action", F.when(F.col("_r") <= keep, "keep").when(F.coalesce(verified, F.lit(False)), "delete").otherwise("skip")).drop("_r")


def age_in_days(then: Column, now: Column) -> Column:
    """Whole days between two times, without a part of a day."""
    return F.floor((F.unix_micros(now.cast("timestamp")) - F.unix_micros(then.cast("timestamp"))) / F.lit(86_400_000_000)).cast("bigint")


def expire(kind: Column, age: Column, days: Mapping[str, int], verified: Column, free: Sequence[str] = ()) -> Column:
    """"keep", "delete" or "skip" by age: what is older than its kind's ``days`` goes if it is verified or its kind is in ``free``.

    Kinds without a number of days and unknown ages are kept.
    """
    limit = F.create_map(*[F.lit(x) for kv in days.items() for x in kv])[kind]
    sure = F.coalesce(verified, F.lit(False)) | (kind.isin(*free) if free else F.lit(False))
    return F.when(~F.coalesce(age > limit, F.lit(False)), "keep").when(sure, "delete").otherwise("skip")


def disk_level(used: Column, total: Column, warning: float = 80, critical: float = 90) -> tuple[Column, Column]:
    """(percent, level): normal, warning or critical; null where nothing is known of the total."""
    percent = F.when(total > 0, used / total * 100)
    return percent, F.when(percent >= critical, "critical").when(percent >= warning, "warning").when(percent.isNotNull(), "normal")


def transfer_verdict(df: DataFrame, group: str, sent: Column, expected: Column, found: Column) -> DataFrame:
    """``(group, total, failed, verified, complete)``: complete only if nothing failed and every size that arrived is the expected one."""
    ok = F.coalesce(sent, F.lit(False))
    right = ok & F.coalesce(expected == found, F.lit(False))
    g = df.groupBy(group).agg(F.count("*").alias("total"), F.count_if(~ok).alias("failed"), F.count_if(right).alias("verified"))
    return g.withColumn("complete", (F.col("failed") == 0) & (F.col("verified") == F.col("total")))


def integrity(baseline: DataFrame, found: DataFrame, key: str, checksum: str) -> DataFrame:
    """``(key, status)`` of a baseline's rows: verified, corrupted (another or no checksum), or missing. Keys are distinct on either side."""
    a = baseline.select(F.col(key).alias("k"), F.col(checksum).alias("a"))
    b = found.select(F.col(key).alias("q"), F.col(checksum).alias("b"))
    status = F.when(F.col("q").isNull(), "missing").when(F.col("a") == F.col("b"), "verified").otherwise("corrupted")
    return a.join(b, F.col("k") == F.col("q"), "left").select(F.col("k").alias(key), status.alias("status"))


def to_restore(status: DataFrame, backup: DataFrame, key: str) -> DataFrame:
    """``(key, source)`` of what isn't verified: "backup" where the backup has it, else "lost"."""
    there = backup.select(F.col(key).alias("q")).distinct()
    bad = status.where("status <> 'verified'")
    return bad.join(there, F.col(key) == F.col("q"), "left").select(key, F.when(F.col("q").isNotNull(), "backup").otherwise("lost").alias("source"))


def annotation_counts(df: DataFrame, path: str, text: str) -> DataFrame:
    """``(path, bytes, sha256, annotations)`` of backup files (path, text): entries of a JSON list, of any other text the lines that aren't blank."""
    t = F.col(text)
    lines = F.size(F.filter(F.split(t, r"\r?\n"), lambda s: F.trim(s) != ""))
    n = F.when(F.ltrim(t).startswith("[") & F.rtrim(t).endswith("]") & F.try_parse_json(t).isNotNull(), F.json_array_length(t)).otherwise(lines)
    return df.select(path, F.octet_length(t).alias("bytes"), F.sha2(t, 256).alias("sha256"), F.coalesce(n, F.lit(0)).cast("bigint").alias("annotations"))
