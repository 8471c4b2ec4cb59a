"""Ranks over a whole table, and what is cut by them, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import cut


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Adds each row's place, from 1, in the given order, which should be a total one.

    Rows are range-partitioned, numbered within their partition and shifted by the number of rows before it: what comes
    to the driver is one count per partition.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    tagged = df.select("*", *keys)
    names = [f"_o{i}" for i in range(len(keys))]
    tagged = cut(tagged.repartitionByRange(n, *names).withColumn("_part", F.spark_partition_id()), "ranked")
    counts = {r[0]: r[1] for r in tagged.groupBy("_part").count().collect()}
    before, shift = 0, {}
    for p in sorted(counts):
        shift[p] = before
        before += counts[p]
    offset = F.create_map(*[F.lit(x).cast("bigint") if i % 2 else F.lit(x) for kv in shift.items() for i, x in enumerate(kv)])[F.col("_part")] if shift else F.lit(0)
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*names))
    return tagged.withColumn(name, local + offset).drop("_part", *names)


def scaled(ratios: Mapping[str, float]) -> dict[str, float]:
    """Ratios that sum to more than 1 are scaled down to it; others are left."""
    s = sum(ratios.values())
    return {k: v / s for k, v in ratios.items()} if s > 1 else dict(ratios)


def by_place(rank: Column, total: Column, ratios: Mapping[str, float], rest: str) -> Column:
    """The split of a rank from 1 of ``total`` rows: floor(total * ratio) rows each, in order, and what is left to ``rest``."""
    out, upto = F.lit(rest), []
    at = F.lit(0)
    for name, r in ratios.items():
        at = at + F.floor(total * F.lit(float(r)))
        upto.append((name, at))
    for name, end in reversed(upto):
        out = F.when(rank <= end, F.lit(name)).otherwise(out)
    return out


def seeded(seed: object, key: Column) -> Column:
    """An order that depends on a seed and a key alone."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))
