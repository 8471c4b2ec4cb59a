"""Joins, inventories and upserts of keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hit_rate(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``(left_rows, joined_rows, hit_percent)``: how many rows an inner join gives, in percent of the left rows."""
    per = right.where(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias("_k")).agg(F.count("*").alias("_n"))
    j = left.join(per, F.col(left_key) == F.col("_k"), "left")
    out = j.agg(F.count("*").alias("left_rows"), F.coalesce(F.sum("_n"), F.lit(0)).alias("joined_rows"))
    return out.withColumn("hit_percent", F.when(F.col("left_rows") > 0, F.round(F.col("joined_rows") / F.col("left_rows") * 100, 2)).otherwise(F.lit(0.0)))


def inner(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """An inner join under different names of the key, both of which are kept; null keys match nothing."""
    return left.join(right, F.col(left_key) == F.col(right_key))


def unmatched(left: DataFrame, right: DataFrame, left_key: str, right_key: str, limit: int | None = 10) -> DataFrame:
    """The first distinct keys, in order, of the left table that the right one lacks (a report: ``limit`` None for all)."""
    r = right.select(F.col(right_key).alias("_k"))
    out = left.join(r, F.col(left_key) == F.col("_k"), "left_anti").select(left_key).where(F.col(left_key).isNotNull()).distinct()
    return out.orderBy(left_key).limit(limit) if limit else out


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """``df`` with ``value`` of the last row (in ``order``, ties to the greatest value) that ``table`` has for the key."""
    last = table.groupBy(F.col(key).alias("_k")).agg(F.max(F.struct(order, value))[value].alias(value))
    return df.join(last, F.col(key) == F.col("_k"), "left").drop("_k")


def patch(df: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with the columns replaced where ``changes`` (one row per key) has a value that isn't null."""
    c = changes.select(F.col(key).alias("_k"), *[F.col(x).alias(f"_{x}") for x in columns])
    j = df.join(c, F.col(key) == F.col("_k"), "left")
    return j.select(*[F.coalesce(F.col(f"_{x}"), F.col(x)).alias(x) if x in columns else F.col(x) for x in df.columns])


def inventory_diff(source: DataFrame, target: DataFrame, path: str, size: str, checksum: str, skip: Column | None = None) -> DataFrame:
    """``(path, status)``: ok, missing (in the target), extra, size_mismatch or checksum_mismatch, the first that holds.

    Checksums are only compared where sizes are equal and both are known, and not where ``skip`` (on ``b``, the target's
    checksum) holds. Nulls in sizes are equal to one another. Paths are distinct on either side.
    """
    s = source.select(F.col(path).alias("p"), F.col(size).alias("sa"), F.col(checksum).alias("a"))
    t = target.select(F.col(path).alias("q"), F.col(size).alias("sb"), F.col(checksum).alias("b"))
    differ = (F.col("a") != F.col("b")) & (~skip if skip is not None else F.lit(True))
    status = (
        F.when(F.col("q").isNull(), "missing").when(F.col("p").isNull(), "extra").when(~F.col("sa").eqNullSafe(F.col("sb")), "size_mismatch")
        .when(F.coalesce(differ, F.lit(False)), "checksum_mismatch").otherwise("ok")
    )
    return s.join(t, F.col("p") == F.col("q"), "full_outer").select(F.coalesce("p", "q").alias(path), status.alias("status"))


def verify_checksums(df: DataFrame, recorded: DataFrame, key: str, checksum: str) -> DataFrame:
    """``(key, status)``: missing (no record), no_checksum (the record has none), mismatch or verified."""
    r = recorded.groupBy(F.col(key).alias("_k")).agg(F.max(checksum).alias("_c"))
    status = F.when(F.col("_k").isNull(), "missing").when(F.coalesce("_c", F.lit("")) == "", "no_checksum").when(F.col("_c").eqNullSafe(F.col(checksum)), "verified").otherwise("mismatch")
    return df.join(r, F.col(key) == F.col("_k"), "left").select(key, status.alias("status"))


def completeness(df: DataFrame, item: str, part: str, parts: Sequence[str]) -> DataFrame:
    """``(item, present, status)``: complete, partial or missing, by how many of the expected parts an item has."""
    n = F.count_distinct(F.when(F.col(part).isin(*parts), F.col(part)))
    return df.groupBy(item).agg(n.alias("present")).withColumn("status", F.when(F.col("present") == len(parts), "complete").when(F.col("present") > 0, "partial").otherwise("missing"))


def append_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` and those rows of ``new`` whose key it lacks (a null key is always new)."""
    return old.unionByName(new.join(old.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_anti"), allowMissingColumns=True)


def upsert_last(tables: Sequence[DataFrame], key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: of the last table that has it, there the greatest by ``order`` and then by the row's values.

    Null keys count as one key.
    """
    every = None
    for i, t in enumerate(tables):
        t = t.withColumn("_src", F.lit(i))
        every = t if every is None else every.unionByName(t)
    cols = [c for c in every.columns if c != "_src"]
    best = every.groupBy(F.col(key).alias("_k")).agg(F.max(F.struct("_src", *order, F.struct(*cols).alias("_row")))["_row"].alias("r"))
    return best.select("r.*")


def resolve_path(df: DataFrame, key: str, candidates: Sequence[Column], inventory: DataFrame, path: str) -> DataFrame:
    """``(key, path)``: the first candidate path of each row that the inventory has, else null.

    One join for all candidates; keys are distinct.
    """
    rows = df.select(F.col(key).alias("_k"), F.posexplode(F.array(*candidates)).alias("_n", "_p"))
    there = inventory.select(F.col(path).alias("_q")).where("_q IS NOT NULL").distinct()
    found = rows.join(there, F.col("_p") == F.col("_q"), "left").groupBy("_k").agg(F.min(F.when(F.col("_q").isNotNull(), F.struct("_n", "_q")))["_q"].alias(path))
    return found.select(F.col("_k").alias(key), path)


def batches(df: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """``df`` with ``batch``, from 0, of ``size`` rows each in the given order."""
    from millrace.operators.ranking import global_rank

    return global_rank(df, order).withColumn("batch", F.floor((F.col("rank") - 1) / F.lit(size)).cast("bigint")).drop("rank")
