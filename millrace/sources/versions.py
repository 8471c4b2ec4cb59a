"""Frozen dataset versions: id lists per split, their counts and recipe, and a registry that is only appended to."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REGISTRY = "version string, created string, total bigint, counts map<string, bigint>, recipe string"


def registry(spark: SparkSession, root: str) -> DataFrame:
    """``REGISTRY`` and ``is_latest`` of all versions; empty where none has been frozen."""
    from millrace.sources.files import _exists

    path = f"{root.rstrip('/')}/registry"
    df = spark.read.schema(REGISTRY).json(path) if _exists(spark, path) else spark.createDataFrame([], REGISTRY)
    last = F.row_number().over(Window.orderBy(F.desc("created"), F.desc("version"))) == 1  # one row per version
    return df.withColumn("is_latest", last)


def next_name(taken: Sequence[str], base: str) -> str:
    """``base``, or with -001, -002, ... the first that isn't taken."""
    if base not in taken:
        return base
    return next(n for i in range(1, len(taken) + 2) if (n := f"{base}-{i:03}") not in taken)


def freeze(df: DataFrame, key: str, root: str, created: str, config: Mapping[str, object] | None = None, split: str = "split") -> str:
    """Writes the ids of each split, and registers the version; returns its name, "v" and ``created`` (YYYYMMDD_HHMMSS)."""
    spark = df.sparkSession
    root = root.rstrip("/")
    name = next_name([r["version"] for r in registry(spark, root).select("version").collect()], f"v{created}")
    df.select(F.col(key), F.col(split).alias("split")).write.partitionBy("split").parquet(f"{root}/{name}/splits")
    counts = {r["split"]: r["count"] for r in spark.read.parquet(f"{root}/{name}/splits").groupBy("split").count().collect()}
    recipe = json.dumps({"version": name, "counts": counts, "config": dict(config or {})}, sort_keys=True, default=str)
    spark.createDataFrame([(name, created, sum(counts.values()), counts, recipe)], REGISTRY).coalesce(1).write.mode("append").json(f"{root}/registry")
    return name


def load(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The ids and splits of a version, or of the latest."""
    if version is None:
        row = registry(spark, root).where("is_latest").first()
        if row is None:
            raise FileNotFoundError(f"no version below {root}")
        version = row["version"]
    return spark.read.parquet(f"{root.rstrip('/')}/{version}/splits")
