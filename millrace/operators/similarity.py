"""All pairs of similar vectors, in blocks of bounded size, and nearest neighbours.

A few pivots are chosen from the data, and each row goes to its nearest one. Rows are put into blocks by pivot and by the
angle to it, so that a block is a shell of a cell; a full shell is cut by a hash. Of each block the least and greatest
angle to every pivot is known. By the triangle inequality two blocks whose ranges of angles to some pivot lie further
apart than the search angle hold no similar pair, and only the other pairs of blocks are compared, as matrix products.
The result is exact: nothing is sampled or capped. On vectors without any structure all pairs of blocks remain, and the
work is quadratic in the rows, as that of any exact similarity join; a row is then shipped once per ``block`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.vectors import dot, doubles, unit
from millrace.runtime import cut

BLOCK = 16384
#: Rows of a block that are compared at once.
TILE = 2048
#: Pivots, rows that they are chosen from, and shells per pivot.
PIVOTS, SAMPLE, SHELLS = 16, 512, 64


def _units(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(float)
    return x / np.maximum(np.sqrt((x * x).sum(1)), 1e-10)[:, None]


def _pivots(rows: DataFrame) -> np.ndarray:
    """Unit vectors far from one another: each next one is the furthest, of the ``SAMPLE`` rows of least hash, from those before."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toPandas()
    if not len(sample):
        return np.zeros((0, 0))
    x = _units(sample["v"])
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(PIVOTS, len(x)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return x[chosen]


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))


def similar_pairs(df: DataFrame, key: str, vector: str, threshold: float, apart: str | None = None, block: int = BLOCK) -> DataFrame:
    """``(id_1, id_2, similarity)``: pairs, id_1 < id_2, of cosine at least ``threshold``, rounded to four places.

    With ``apart`` only pairs that differ in that column (a null differs from nothing) count. Rows with a null key or
    vector take no part, and a zero vector is similar to none. All vectors are of one length; equal keys never pair.
    An empty table gives no pairs. A threshold must be above 0.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    theta = math.acos(min(1.0, threshold)) + 1e-7
    side = F.col(apart).cast("string") if apart else F.lit(None).cast("string")
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).alias("id"), side.alias("side"), F.col(vector).alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    kind, shape = kinds["id"], f"id {kinds['id']}, side string, v {kinds['v']}"
    pivots = _pivots(rows)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                a = _angles(_units(b["v"]), pivots)
                b["cell"] = a.argmin(1)
                b["shell"] = np.minimum((a.min(1) * (SHELLS / math.pi)).astype(int), SHELLS - 1)
                b["angles"] = list(a)
                yield b

    placed = cut(rows.mapInPandas(place, f"{shape}, cell int, shell int, angles array<double>"), "placed")
    # at most PIVOTS x SHELLS sums; shells are taken together, in order, until a block is full
    blocks, n, held, last = {}, 0, 0, None
    for r in placed.groupBy("cell", "shell").count().orderBy("cell", "shell").collect():
        if last is not None and (r["cell"] != last or held + r["count"] > block):
            n, held = n + blocks[at][1], 0
        parts = max(1, math.ceil(r["count"] / block))
        at, last, held = (r["cell"], r["shell"]), r["cell"], held + r["count"]
        blocks[at] = (n, parts)
    named = df.sparkSession.createDataFrame([(c, s, b, p) for (c, s), (b, p) in blocks.items()], "cell int, shell int, base int, parts int")
    placed = placed.join(F.broadcast(named), ["cell", "shell"]).withColumn("mine", F.col("base") + F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # the ranges of angles: one row per block, so fewer than the rows by the size of a block
    k = len(pivots)
    at = [F.get("angles", i) for i in range(k)]
    ranges = placed.groupBy("mine").agg(F.array(*[F.min(a) for a in at]).alias("lo"), F.array(*[F.max(a) for a in at]).alias("hi")).toPandas().sort_values("mine")
    ids = ranges["mine"].to_numpy()
    low, high = (np.stack(ranges[c].to_numpy()) if len(ranges) else np.zeros((0, k)) for c in ("lo", "hi"))

    def partners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i in np.searchsorted(ids, b["mine"]):
                near = (np.maximum(low - high[i], low[i] - high) <= theta).all(1)
                out.append(ids[near].tolist())
            yield pd.DataFrame({"mine": b["mine"], "others": out})

    who = df.sparkSession.createDataFrame([(int(i),) for i in ids], "mine int").mapInPandas(partners, "mine int, others array<int>")
    rows = placed.select("id", "side", "v", "mine").join(who, "mine").select("id", "side", "v", "mine", F.explode("others").alias("other"))
    rows = rows.withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other")).drop("other")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, sims = [], [], []
        a = pdf[pdf["mine"] == pdf["lo"].iloc[0]]
        b = a if pdf["lo"].iloc[0] == pdf["hi"].iloc[0] else pdf[pdf["mine"] == pdf["hi"].iloc[0]]
        if len(a) and len(b):
            x = _units(a["v"])
            y = x if b is a else _units(b["v"])
            ia, ib, sa, sb = a["id"].to_numpy(), b["id"].to_numpy(), a["side"].to_numpy(), b["side"].to_numpy()
            for s in range(0, len(x), TILE):
                for t in range(0, len(y), TILE):
                    sim = x[s : s + TILE] @ y[t : t + TILE].T
                    i, j = np.nonzero(sim >= threshold - 1e-12)
                    v = sim[i, j]
                    i, j = i + s, j + t
                    ok = ia[i] < ib[j] if b is a else ia[i] != ib[j]
                    if apart:
                        ok &= np.array([p is not None and q is not None and p != q for p, q in zip(sa[i], sb[j])], bool)
                    left.append(ia[i[ok]]), right.append(ib[j[ok]]), sims.append(v[ok])
        if not sum(map(len, sims)):
            return pd.DataFrame({"id_1": pdf["id"].iloc[:0], "id_2": pdf["id"].iloc[:0], "similarity": pd.Series([], dtype=float)})
        p, q = np.concatenate(left), np.concatenate(right)
        return pd.DataFrame({"id_1": np.where(p < q, p, q), "id_2": np.where(p < q, q, p), "similarity": np.concatenate(sims)})

    out = rows.groupBy("lo", "hi").applyInPandas(compare, f"id_1 {kind}, id_2 {kind}, similarity double")
    return out.withColumn("similarity", F.round("similarity", 4))


def nearest(df: DataFrame, vector: str, centroids: dict[object, list[float]], metric: str = "euclidean") -> DataFrame:
    """Adds ``nearest`` and ``distance`` to the nearest of a few centroids, held as literals (ties to the smaller label)."""
    v = doubles(F.col(vector))
    options = []
    for label, c in sorted(centroids.items(), key=lambda kv: str(kv[0])):
        ref = F.array(*[F.lit(float(x)) for x in c])
        d = 1 - dot(unit(v), unit(ref)) if metric == "cosine" else F.sqrt(dot(F.zip_with(v, ref, lambda x, y: x - y), F.zip_with(v, ref, lambda x, y: x - y)))
        options.append(F.struct(d.alias("distance"), F.lit(label).alias("nearest")))
    best = F.array_min(F.array(*options)) if options else F.struct(F.lit(None).cast("double").alias("distance"), F.lit(None).cast("int").alias("nearest"))
    return df.withColumn("_b", best).select("*", F.col("_b.nearest").alias("nearest"), F.col("_b.distance").alias("distance")).drop("_b")


def top_neighbours(df: DataFrame, queries: DataFrame, key: str, vector: str, k: int, block: int = TILE) -> DataFrame:
    """``(query, id, distance, place)``: the k nearest rows of each query by cosine distance, itself among them.

    Queries come in blocks; each block passes once over all rows, which keep only its best k of every batch, and the
    partial lists are merged by their rank.
    """
    q = queries.where(F.col(vector).isNotNull()).select(F.col(key).alias("query"), unit(doubles(F.col(vector))).alias("qv"))
    n = max(1, math.ceil(q.count() / block))
    q = q.withColumn("b", F.pmod(F.xxhash64("query"), F.lit(n)).cast("int"))
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), unit(doubles(F.col(vector))).alias("v"))
    parts = max(1, math.ceil(rows.count() / (8 * block)))
    rows = rows.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    q = q.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    kind = df.schema[key].dataType.simpleString()

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        cols = ["query", "id", "distance"]
        if left.empty or right.empty:
            return pd.DataFrame(columns=cols)
        d = 1 - np.stack(left["qv"].to_numpy()) @ np.stack(right["v"].to_numpy()).T
        ids = right["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        d, ids = np.round(d[:, order], 9), ids[order]
        best = np.argsort(d, axis=1, kind="stable")[:, :k]
        rows_ = np.repeat(np.arange(len(left)), best.shape[1])
        return pd.DataFrame({"query": left["query"].to_numpy()[rows_], "id": ids[best.ravel()], "distance": d[rows_, best.ravel()]})

    got = q.groupBy("b", "part").cogroup(rows.groupBy("b", "part")).applyInPandas(search, f"query {kind}, id {kind}, distance double")
    place = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    return got.withColumn("place", place).where(F.col("place") <= k)
