"""Train, validation, test and holdout splits by time, stratum or group, and their verification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import by_place, global_rank, scaled, seeded

RATIOS = {"train": 0.80, "val": 0.10, "test": 0.10, "holdout_gold": 0.01}


def _cut(ratios: Mapping[str, float]) -> tuple[dict[str, float], str]:
    names = list(ratios)
    s = scaled(ratios)
    return {n: s[n] for n in names[:-1]}, names[-1]


def _total(df: DataFrame) -> Column:
    return F.lit(df.count())


def temporal_split(df: DataFrame, time: str, key: str, ratios: Mapping[str, float] = RATIOS) -> DataFrame:
    """Adds ``split``: earliest rows first, null times last, ties by ``key``. What floor() leaves falls to the last split."""
    head, rest = _cut(ratios)
    ranked = global_rank(df, [F.col(time).isNull(), F.col(time), F.col(key)])
    return ranked.withColumn("split", by_place(F.col("rank"), _total(ranked), head, rest)).drop("rank")


def temporal_shuffled_split(df: DataFrame, time: str, key: str, ratios: Mapping[str, float] = RATIOS, seed: object = 42) -> DataFrame:
    """``temporal_split``, and ``place``: each row's place, from 1, in a shuffled order of its split."""
    from millrace.operators.ranking import global_rank

    cut_ = temporal_split(df, time, key, ratios)
    ranked = global_rank(cut_, [F.col("split"), seeded(seed, F.col(key)), F.col(key)], "place")
    first = ranked.groupBy("split").agg((F.min("place") - 1).alias("_before"))
    return ranked.join(first, "split").withColumn("place", F.col("place") - F.col("_before")).drop("_before")


def random_split(df: DataFrame, key: str, ratios: Mapping[str, float] = RATIOS, seed: object = 42) -> DataFrame:
    """Adds ``split`` by the order of a hash of seed and key: the same for the same rows, however they are laid out."""
    head, rest = _cut(ratios)
    ranked = global_rank(df, [seeded(seed, F.col(key)), F.col(key)])
    return ranked.withColumn("split", by_place(F.col("rank"), _total(ranked), head, rest)).drop("rank")


def stratified_split(df: DataFrame, stratum: str, key: str, ratios: Mapping[str, float] = RATIOS, seed: object = 42) -> DataFrame:
    """Adds ``split``: each stratum (null is one) is cut by itself. No stratum, however large, is one task's group."""
    head, rest = _cut(ratios)
    s = F.coalesce(F.col(stratum).cast("string"), F.lit("\0null"))
    ranked = global_rank(df.withColumn("_s", s), [F.col("_s"), seeded(seed, F.col(key)), F.col(key)])
    sizes = ranked.groupBy("_s").agg(F.count("*").alias("_n"), (F.min("rank") - 1).alias("_before"))
    out = ranked.join(sizes, "_s").withColumn("split", by_place(F.col("rank") - F.col("_before"), F.col("_n"), head, rest))
    return out.drop("_s", "_n", "_before", "rank")


def isolated_split(df: DataFrame, group: str, ratios: Mapping[str, float] = RATIOS, seed: object = 42) -> DataFrame:
    """Adds ``split``: groups, not rows, are cut, so that none spans two splits. Rows without a group have no split."""
    groups = df.select(group).where(F.col(group).isNotNull()).distinct()
    return df.join(random_split(groups, group, ratios, seed), group, "left")


def holdout_first_split(df: DataFrame, key: str, holdout: float = 0.1, test: float = 0.1, val: float = 0.1, seed: object = 42) -> DataFrame:
    """Adds ``split``: the holdout is cut first, then test and validation; all else trains."""
    ranked = global_rank(df, [seeded(seed, F.col(key)), F.col(key)])
    ratios = {"holdout_gold": holdout, "test": test, "val": val}
    return ranked.withColumn("split", by_place(F.col("rank"), _total(ranked), ratios, "train")).drop("rank")


def replace_from_pool(df: DataFrame, pool: DataFrame, split: str, key: str, fallback: str = "train") -> DataFrame:
    """``df`` with a split replaced by an independent pool; displaced rows go to ``fallback`` unless their key is there."""
    kept = df.where(F.col("split") != split)
    there = df.where(F.col("split") == fallback).select(key).distinct()
    moved = df.where(F.col("split") == split).join(there, key, "left_anti").withColumn("split", F.lit(fallback))
    return kept.unionByName(moved).unionByName(pool.withColumn("split", F.lit(split)), allowMissingColumns=True)


def statistics(df: DataFrame, split: str = "split") -> DataFrame:
    """``(split, n, ratio)``; the ratio of an empty table is over 1 row."""
    counts = df.groupBy(split).agg(F.count("*").alias("n"))
    total = df.count()
    return counts.withColumn("ratio", F.col("n") / F.lit(max(1, total)))


def leaked(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """``(key, splits)``: keys that stand in more than one split, with those splits in order."""
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(split)).alias("splits"))
    return g.where(F.size("splits") > 1)


def overlaps(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """``(left, right, n)``: the number of keys that each pair of splits shares, for pairs that share some."""
    s = leaked(df, key, split).select("splits")
    pair = F.flatten(F.transform("splits", lambda a: F.transform(F.filter("splits", lambda b: b > a), lambda b: F.struct(a.alias("left"), b.alias("right")))))
    return s.select(F.explode(pair).alias("p")).groupBy("p.left", "p.right").agg(F.count("*").alias("n"))


def verify(df: DataFrame, manifest: DataFrame, checksums: DataFrame, key: str, expected: Sequence[str], split: str = "split") -> DataFrame:
    """One row per check ``(check, failures, passed)``: completeness, leakage, existence, checksum, and all of them.

    completeness counts rows repeated within a split and expected splits without rows; existence, keys the manifest
    lacks; checksum, those without a recorded hash.
    """
    spark = df.sparkSession
    rows = df.where(F.col(key).isNotNull())
    again = rows.groupBy(split, key).agg((F.count("*") - 1).alias("x")).agg(F.coalesce(F.sum("x"), F.lit(0)).alias("failures"))
    seen = spark.createDataFrame([(s,) for s in expected], "s string").join(rows.select(F.col(split).alias("s")).distinct(), "s", "left_anti").agg(F.count("*").alias("failures"))
    keys = rows.select(key).distinct()
    checks = [
        ("completeness", again.unionByName(seen).agg(F.sum("failures").alias("failures"))),
        ("leakage", leaked(df, key, split).agg(F.count("*").alias("failures"))),
        ("existence", keys.join(manifest.select(key), key, "left_anti").agg(F.count("*").alias("failures"))),
        ("checksum", keys.join(checksums.select(key), key, "left_anti").agg(F.count("*").alias("failures"))),
    ]
    out = None
    for name, c in checks:
        one = c.select(F.lit(name).alias("check"), "failures")
        out = one if out is None else out.unionByName(one)
    out = out.unionByName(out.agg(F.lit("overall").alias("check"), F.sum("failures").alias("failures")))
    return out.withColumn("passed", F.col("failures") == 0)


def shared_batches(df: DataFrame, manifest: DataFrame, key: str, batch: str, split: str = "split", learned: Sequence[str] = ("train", "val"), apart: Sequence[str] = ("test", "holdout_gold")) -> DataFrame:
    """``(split, batch)``: import batches of a split in ``apart`` from which ``learned`` splits have records, too.

    Keys that the manifest lacks and records without a batch belong to none.
    """
    of = manifest.where(F.col(key).isNotNull() & F.col(batch).isNotNull()).select(key, F.col(batch).alias("batch")).distinct()
    seen = df.select(key, F.col(split).alias("split")).join(of, key).select("split", "batch").distinct()
    known = seen.where(F.col("split").isin(*learned)).select("batch").distinct()
    return seen.where(F.col("split").isin(*apart)).join(known, "batch", "left_semi").select("split", "batch")


def isolation(df: DataFrame, manifest: DataFrame, key: str, batch: str, split: str = "split", apart: Sequence[str] = ("test", "holdout_gold")) -> DataFrame:
    """One row per split that is to stand apart: ``(split, shared, passed)``, the number of batches that it shares."""
    shared = shared_batches(df, manifest, key, batch, split, apart=apart).groupBy("split").agg(F.count("*").alias("shared"))
    names = df.sparkSession.createDataFrame([(s,) for s in apart], "split string")
    return names.join(shared, "split", "left").select("split", F.coalesce("shared", F.lit(0)).alias("shared")).withColumn("passed", F.col("shared") == 0)


def require_apart(df: DataFrame, key: str, split: str = "split", strict: bool = True) -> DataFrame:
    """``leaked``; with ``strict`` an error if there is any."""
    found = leaked(df, key, split)
    if strict and (first := found.first()):
        raise ValueError(f"{key} {first[key]!r} stands in {', '.join(first['splits'])}")
    return found


def seen_before(df: DataFrame, key: str, order: Sequence[str], split: str = "split") -> DataFrame:
    """``(split, n, seen)``: distinct keys of each split, and how many of them a split earlier in ``order`` has."""
    place = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(split))
    rows = df.where(F.col(key).isNotNull() & (place > 0)).select(F.col(key).alias("k"), F.col(split).alias("split"), place.alias("o")).distinct()
    first = rows.groupBy("k").agg(F.min("o").alias("first"))
    return rows.join(first, "k").groupBy("split").agg(F.count("*").alias("n"), F.count_if(F.col("first") < F.col("o")).alias("seen"))
