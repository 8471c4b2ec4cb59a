"""Mixing sources to target weights by hash-threshold histograms.

Sizes are summed by source and hash bucket, the bucket in which a source's budget is used up is found in the histogram,
and only that bucket is summed again by finer hash bits, until a single record is left in it. What is chosen is then a
filter on the hash: nothing is sorted, and a source that holds most of the data is no large group anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.strings import folded

BITS, LEVELS = 10, 6


def plan(available: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, tuple[float, float]]:
    """Per source its scaled share and its budget.

    Sources without size, share or allowed repeats can hold nothing: the others' shares are scaled to sum to 1. Without a
    ``total`` the largest one is taken at which every source can hold its share; with one, a source that would need
    more than its allowed repeats stays below its share.
    """
    live = {s: (w, k) for s, (w, k) in targets.items() if available.get(s, 0) > 0 and w > 0 and k > 0}
    whole = sum(w for w, _ in live.values())
    share = {s: w / whole for s, (w, _) in live.items()}
    if total is None:
        total = min((available[s] * live[s][1] / share[s] for s in live), default=0.0)
    return {s: (share[s], min(share[s] * total, float(available[s] * live[s][1]))) for s in live}


class Mix:
    """The records of ``df`` (key, source, size) to take, with their repeats.

    Every source in ``targets`` (source: share, most repeats) gets whole passes over its records and a part of a further
    one, chosen by the records' hash, so that its size comes to its budget within the size of one record. Records without
    a source in ``targets``, or without size, are left out. ``df`` is read several times and should be a written table.
    """

    def __init__(self, df: DataFrame, targets: dict[str, tuple[float, int]], total: float | None = None, seed: int = 0):
        self.targets = targets
        df = df.where(F.col("source").isin(list(targets)) & (F.col("size") > 0)).withColumn("h", F.xxhash64(F.lit(seed), "key"))
        prefix = lambda level: F.shiftrightunsigned("h", 64 - BITS * level)

        def sums(part: DataFrame, level: int) -> dict[str, list[tuple[int, int, int]]]:
            # at most sources x 2^BITS rows: the histogram's size doesn't depend on the data's
            got: dict[str, list[tuple[int, int, int]]] = {}
            for r in part.groupBy("source", prefix(level).alias("b")).agg(F.sum("size").alias("n"), F.count("*").alias("k")).collect():
                got.setdefault(r["source"], []).append((r["b"], r["n"], r["k"]))
            return {s: sorted(v) for s, v in got.items()}

        first = sums(df, 1)
        self.available = {s: sum(n for _, n, _ in v) for s, v in first.items()}
        self.plan = plan(self.available, targets, total)
        self.passes = {s: int(b // self.available[s]) for s, (_, b) in self.plan.items()}
        left = {s: b - self.passes[s] * self.available[s] for s, (_, b) in self.plan.items()}
        self.below = dict.fromkeys(self.plan, 0)
        open_ = {s for s in self.plan if left[s] > 0}
        hist = first
        for level in range(1, LEVELS + 1):
            edge: dict[str, int] = {}
            for s in open_:
                for b, n, k in hist[s]:
                    if n <= left[s]:
                        left[s] -= n
                        continue
                    at = b << (BITS * (LEVELS - level))
                    self.below[s] = at
                    if k > 1 and level < LEVELS:
                        edge[s] = b
                    elif left[s] * 2 >= n:  # the boundary record itself, where that comes nearer to the budget
                        self.below[s] = at + (1 << (BITS * (LEVELS - level)))
                    break
                else:
                    self.below[s] = 1 << (BITS * LEVELS) if level == 1 else (hist[s][-1][0] + 1) << (BITS * (LEVELS - level))
            open_ = set(edge)
            if not edge:
                break
            inside = F.lit(False)
            for s, b in edge.items():
                inside = inside | ((F.col("source") == s) & (prefix(level) == F.lit(b)))
            hist = sums(df.where(inside), level + 1)
        repeats = F.lit(0)
        for s in self.plan:
            n = F.lit(self.passes[s]) + (prefix(LEVELS) < F.lit(self.below[s])).cast("int")
            repeats = F.when(F.col("source") == s, n).otherwise(repeats)
        self.chosen = df.withColumn("repeats", repeats).where("repeats > 0").drop("h")

    def shares(self) -> DataFrame:
        """Per source in ``targets``: target as given, target scaled to the sources that have records, actual share."""
        spark = self.chosen.sparkSession
        got = {r["source"]: r for r in self.chosen.groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("n"), F.count("*").alias("k"), F.max("repeats").alias("r")).collect()}
        whole = sum(r["n"] for r in got.values()) or 1
        rows = [
            (s, float(w), self.plan.get(s, (0.0, 0))[0], (got[s]["n"] / whole) if s in got else 0.0, k, got[s]["r"] if s in got else 0,
             self.available.get(s, 0), got[s]["n"] if s in got else 0, got[s]["k"] if s in got else 0)
            for s, (w, k) in sorted(self.targets.items())
        ]
        return spark.createDataFrame(
            rows, "source string, target_share double, scaled_share double, actual_share double, max_repeats int, repeats int, available_tokens bigint, mixed_tokens bigint, records bigint"
        )


def read_targets(df: DataFrame) -> dict[str, tuple[float, int]]:
    """The fixed table (source, target_share, max_repeats); of a source given twice shares add up and the lower cap holds."""
    out: dict[str, tuple[float, int]] = {}
    for r in df.select(folded(F.col("source")).alias("s"), "target_share", "max_repeats").where("s IS NOT NULL").distinct().orderBy("s").collect():
        w, k = out.get(r["s"], (0.0, 1 << 30))
        out[r["s"]] = (w + (r["target_share"] or 0.0), min(k, r["max_repeats"] if r["max_repeats"] is not None else 1))
    return out
