"""All outputs of a run under one version's folder, and near-duplicate removal in stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import dedup
from millrace.plans.pipeline import Result, Run, Stage
from millrace.runtime import cut

#: Stages that write to one place, by the name of that place.
SHARED: Mapping[str, str] = {"validate": "manifest", "standardise": "manifest", "quality": "manifest", "deduplicate": "manifest"}


def output_path(root: str, version: str, stage: str, shared: Mapping[str, str] = SHARED) -> str:
    """The folder of a stage's output in a version."""
    return f"{root.rstrip('/')}/{version}/{shared.get(stage, stage)}"


def write_bundle(run: Run, key: str, root: str, version: str, reports: Mapping[str, DataFrame] = {}) -> dict[str, str]:
    """Writes a run's data, rejects, counts and further reports under one version; returns the paths by name. One job per table, files in Parquet."""
    tables = {"data": run.data, "counts": run.counts(), **reports}
    gone = run.rejects(key)
    if gone is not None:
        tables["rejects"] = gone
    paths = {n: output_path(root, version, n) for n in tables}
    for n, df in tables.items():
        df.write.mode("overwrite").parquet(paths[n])
    return paths


def dedup_stages(key: str, hash_: str, size: str, pairs, quality: Sequence[str], split: str | None = None) -> list[Stage]:
    """Stages "exact", "near" and, with ``split``, "across": copies by hash, then the losers of similar pairs, then what
    similar pairs in different splits remove from the less worthy one. ``pairs`` makes similar pairs (id_1, id_2, similarity) of a table."""

    def without(df: DataFrame, gone: DataFrame, reason: str) -> Result:
        g = gone.select(F.col("remove").alias("_g")).distinct()
        out = df.join(g, F.col(key) == F.col("_g"), "left_semi")
        return Result(df.join(g, F.col(key) == F.col("_g"), "left_anti"), out.withColumn("reason", F.lit(reason)))

    def exact(df: DataFrame, c: dict) -> Result:
        return without(df, dedup.exact_links(df, hash_, key, size), "same_hash")

    def near(df: DataFrame, c: dict) -> Result:
        return without(df, dedup.greedy(cut(pairs(df), "pairs"), df, key, list(quality)), "similar")

    def across(df: DataFrame, c: dict) -> Result:
        p = dedup.split_priority(cut(pairs(df), "pairs"), df, key, split)
        s = df.select(F.col(key).alias("id"), F.col(split).alias("s")).distinct()
        lose = [p.join(s, (F.col(i) == s["id"]) & (F.col("remove_from") == s["s"])).select(F.col(i).alias("remove")) for i in ("id_1", "id_2")]
        return without(df, lose[0].union(lose[1]), "leaks")

    return [Stage("exact", exact), Stage("near", near), *([Stage("across", across)] if split else [])]
