"""Clusters of mutually similar records of numeric fields: MinHash banding, exact Jaccard, tolerances, connected components.

Two records are alike if they differ by at most a tolerance in every field. Space is cut into cells one tolerance wide,
so records of one cell are all alike, and only links between cells are sought: pairs within a cell are never made.

A cell's token set holds, for each of ``k`` grids of k-fold width, shifted by one tolerance each, the coarse cell it lies
in. A pair of cells that differ by at most one tolerance per field is cut apart by at most one grid per field, so alike
records share at least k - f of the k tokens of f fields: a Jaccard similarity of at least (k - f) / (k + f).

Candidates come from MinHash signatures in bands of several rows. The permutations aren't drawn independently, but as a
covering family: that of row g puts the tokens of grid g before all others, each in the order of a seeded hash, so that
row g of a signature is the hash of the token of grid g. The k rows are dealt to k - f - 1 bands; a pair that shares
k - f tokens shares two or more of some band by the pigeonhole principle, and a band is keyed once for each two of its
rows. So banding misses no pair whose Jaccard similarity is high enough, which independent permutations couldn't promise.
Shifts of a band's rows lie far apart, so that cells which share two of them are near in every field. Of the candidates
exact Jaccard rejects those with fewer than k - f shared tokens, and the tolerances verify the rest.

Of a full cell only the records that can decide a link are kept: those of its 2^f skylines, one per direction. A link to
a neighbouring cell exists if and only if one exists between the skylines that face each other, and skylines of parts
merge into that of the whole, so that a hot cell is reduced where its rows are read. Cells that share two tokens of
a band are at most (k - 1)^f, so that a band's group is bounded by geometry and the skylines, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.graph import connected_components
from millrace.runtime import cut

#: A cell of up to so many records keeps them all.
SMALL_CELL = 48
#: Grids, and so rows of a signature.
GRIDS = 8


def bands(k: int, f: int) -> list[tuple[int, int]]:
    """The pairs of signature rows that make a key: those within one of k - f - 1 bands, to which the rows are dealt in turn."""
    n = k - f - 1
    return [(g, h) for b in range(n) for g in range(b, k, n) for h in range(g + n, k, n)]


def skyline(x: np.ndarray) -> np.ndarray:
    """Indexes of the rows of ``x`` that no other row exceeds or equals in every column (of equal rows one is kept)."""
    order = np.argsort(-x.sum(1), kind="stable")
    live, kept = order, []
    while len(live):
        best = live[0]
        kept.append(best)
        live = live[1:]
        live = live[(x[live] > x[best]).any(1)]
    return np.array(kept, np.int64)


def facing(x: np.ndarray) -> np.ndarray:
    """The rows of a cell that lie in the skyline of some direction."""
    if len(x) <= SMALL_CELL:
        return np.arange(len(x))
    f = x.shape[1]
    keep = np.zeros(len(x), bool)
    for signs in range(1 << f):
        s = np.array([1.0 if signs >> i & 1 else -1.0 for i in range(f)])
        keep[skyline(x * s)] = True
    return np.flatnonzero(keep)


def _reduce(cells: list[str], values: list[str], flush: int = 200_000):
    """Keeps the facing rows of each cell, over a partition's rows; what is held is reduced again as it grows."""

    def squeeze(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(cells, kind="stable", ignore_index=True)
        c, x = b[cells].to_numpy(), b[values].to_numpy(float)
        cuts = np.flatnonzero(np.append(True, (c[1:] != c[:-1]).any(1)))
        stops = np.append(cuts[1:], len(b))
        keep = np.ones(len(b), bool)
        for i in np.flatnonzero(stops - cuts > SMALL_CELL):
            part = slice(cuts[i], stops[i])
            keep[part] = False
            keep[cuts[i] + facing(x[part])] = True
        return b[keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += len(b)
            if size > flush:
                held = [squeeze(pd.concat(held))]
                size = 0 if len(held[0]) < flush // 2 else len(held[0])
                if size:
                    yield held[0]
                    held, size = [], 0
        if held:
            yield squeeze(pd.concat(held))

    return run


def _spans(count: np.ndarray, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For ``count[i]`` items of each i: (i, number of the item within i) of all items, so many at a time (at least one i)."""
    upto = np.concatenate(([0], np.cumsum(count)))
    i = 0
    while i < len(count):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + at_once, "right")) - 1)
        n = count[i:j]
        owner = np.repeat(np.arange(i, j), n)
        yield owner, np.arange(len(owner)) - np.repeat(upto[i:j] - upto[i], n)
        i = j


def _near_rows(x: np.ndarray, a: np.ndarray, b: np.ndarray, starts: np.ndarray, stops: np.ndarray, low: np.ndarray, high: np.ndarray, widths: np.ndarray, at_once: int) -> np.ndarray:
    """Whether some row of cell ``a[p]`` lies within ``widths`` of some row of cell ``b[p]``, for each p."""
    found = np.zeros(len(a), bool)
    na, nb = stops[a] - starts[a], stops[b] - starts[b]
    small = na * nb <= 4096
    idx = np.flatnonzero(small)
    for p, k in _spans((na * nb)[idx], at_once):
        p = idx[p]
        hit = (np.abs(x[starts[a[p]] + k // nb[p]] - x[starts[b[p]] + k % nb[p]]) <= widths).all(1)
        found[p[hit]] = True
    for p in np.flatnonzero(~small):
        # of either cell only what lies within reach of the other's box
        r, t = x[starts[a[p]] : stops[a[p]]], x[starts[b[p]] : stops[b[p]]]
        r = r[((r >= low[b[p]] - widths) & (r <= high[b[p]] + widths)).all(1)]
        t = t[((t >= low[a[p]] - widths) & (t <= high[a[p]] + widths)).all(1)]
        step = max(1, at_once // max(1, len(t)))
        found[p] = any((np.abs(r[s : s + step, None] - t[None]) <= widths).all(2).any() for s in range(0, len(r), step))
    return found


def _links(cells: list[str], values: list[str], widths: np.ndarray, k: int, pairs_at_once: int = 1_000_000):
    """From rows sorted by band key and cell: the linked pairs of cells that meet, each pair under its first shared key only."""
    f = len(cells)
    keyed = bands(k, f)
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93] * f, np.uint64)[:f]

    def linked(key: np.ndarray, c: np.ndarray, x: np.ndarray) -> Iterator[np.ndarray]:
        fresh = (key[1:] != key[:-1]).any(1)
        starts = np.flatnonzero(np.append(True, fresh | (c[1:] != c[:-1]).any(1)))
        stops = np.append(starts[1:], len(c))
        u, at = c[starts], key[starts, 0]
        groups = np.flatnonzero(np.append(True, (key[starts][1:] != key[starts][:-1]).any(1)))
        ends = np.repeat(np.append(groups[1:], len(u)), np.diff(np.append(groups, len(u))))
        low, high = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
        # the token of each grid as one number
        with np.errstate(over="ignore"):
            tokens = [(np.floor_divide(u + t, k).astype(np.uint64) * odd).sum(1, dtype=np.uint64) for t in range(k)]
        for i, j in _spans(ends - 1 - np.arange(len(u)), pairs_at_once):
            j = i + 1 + j
            # exact Jaccard of the token sets: n shared of 2k - n, at least (k - f) of (k + f)
            same = [t[i] == t[j] for t in tokens]
            n = np.sum(same, 0, dtype=np.int64)
            ok = n * (k + f) >= (k - f) * (2 * k - n)
            # under its first shared key; boxes too far apart hold no link, and of single records the box is the record
            first = np.zeros(len(i), bool)
            seen = np.zeros(len(i), bool)
            for q, (g, h) in enumerate(keyed):
                both = same[g] & same[h]
                first |= both & ~seen & (at[i] == q)
                seen |= both
            ok &= first
            i, j = i[ok], j[ok]
            ok = (np.maximum(low[j] - high[i], low[i] - high[j]) <= widths).all(1)
            i, j = i[ok], j[ok]
            single = (stops[i] - starts[i] == 1) & (stops[j] - starts[j] == 1)
            yield np.hstack([u[i[single]], u[j[single]]])
            i, j = i[~single], j[~single]
            near = _near_rows(x, i, j, starts, stops, low, high, widths, pairs_at_once)
            yield np.hstack([u[i[near]], u[j[near]]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f"a_{c}" for c in cells] + [f"b_{c}" for c in cells]

        def close(parts: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            b = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
            for found in linked(b[["band", "key"]].to_numpy(), b[cells].to_numpy(), b[values].to_numpy(float)):
                if len(found):
                    yield pd.DataFrame(found, columns=names)

        open_: list[pd.DataFrame] = []  # whole bands, and parts of the last one, which may go on with the next batch
        for b in batches:
            if not len(b):
                continue
            key = b[["band", "key"]].to_numpy()
            last = int(np.flatnonzero((key != key[-1]).any(1))[-1]) + 1 if (key != key[-1]).any() else 0
            goes_on = not last and open_ and (open_[-1][["band", "key"]].to_numpy()[-1] == key[0]).all()
            if goes_on:
                open_.append(b)
                continue
            if last or open_:
                yield from close([*open_, b.iloc[:last]] if last else open_)
            open_ = [b.iloc[last:]]
        if open_:
            yield from close(open_)

    return run


class Clusters:
    """Clusters of ``df``'s records by ``tolerances`` (field: greatest difference); see the module's text.

    A record is a distinct row of key and fields; a key with several distinct rows is several records of that key.
    Records with a null key, or a null, NaN or infinite field, take no part. An empty table gives no clusters. Other
    columns are not read.
    """

    def __init__(self, df: DataFrame, key: str, tolerances: Mapping[str, float], k: int = GRIDS, seed: int = 0):
        fields, widths = list(tolerances), np.array(list(tolerances.values()), float)
        f = len(fields)
        if k < f + 2:
            raise ValueError("at least two more grids than fields are needed")
        self.widths = widths
        self.cells, self.values = [f"c{i}" for i in range(f)], [f"x{i}" for i in range(f)]
        rec = df.select(df[key].alias("id"), *[df[n].cast("double").alias(x) for n, x in zip(fields, self.values)])
        sound = [F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) for x in self.values]
        for s in (F.col("id").isNotNull(), *sound):
            rec = rec.where(s)
        rec = rec.distinct()
        for c, x, w in zip(self.cells, self.values, widths):
            # beyond 2^52 tolerances neighbouring doubles are further apart than one: only equal values are alike there
            far = F.lit(1 << 59) + F.pmod(F.xxhash64(x), F.lit(1 << 58))
            rec = rec.withColumn(c, F.when(F.abs(F.col(x) / F.lit(float(w))) < float(1 << 52), F.floor(F.col(x) / F.lit(float(w)))).otherwise(far).cast("bigint"))
        self.records = cut(rec, "records")
        self.counts = self.records.groupBy(*self.cells).agg(F.count("*").alias("n"), F.min("id").alias("least"))
        reduce = _reduce(self.cells, self.values)
        shape = ", ".join([f"{c} bigint" for c in self.cells] + [f"{x} double" for x in self.values])
        rows = self.records.select(*self.cells, *self.values).mapInPandas(reduce, shape)
        self.facing = rows.repartition(*self.cells).mapInPandas(reduce, shape)
        coarse = lambda g: [F.floor((F.col(c) + g) / F.lit(k)).cast("bigint") for c in self.cells]
        rows_ = [F.xxhash64(F.lit(seed), F.lit(g), *coarse(g)) for g in range(k)]  # the signature
        keys = [F.struct(F.lit(i).cast("bigint").alias("band"), F.xxhash64(rows_[g], rows_[h]).alias("key")) for i, (g, h) in enumerate(bands(k, f))]
        banded = self.facing.select("*", F.explode(F.array(*keys)).alias("b")).select("b.*", *self.cells, *self.values)
        banded = banded.repartition("band", "key").sortWithinPartitions("band", "key", *self.cells)
        out = ", ".join(f"{s}_{c} bigint" for s in "ab" for c in self.cells)
        self.links = cut(banded.mapInPandas(_links(self.cells, self.values, widths, k), out), "links")

    def _named(self) -> DataFrame:
        """Cells as one string each, with size and least id."""
        return self.counts.withColumn("cell", F.concat_ws("_", *self.cells))

    def _cell_links(self) -> DataFrame:
        return self.links.select(*[F.concat_ws("_", *[f"{s}_{c}" for c in self.cells]).alias(s) for s in "ab"])

    def components(self, least_size: int = 1) -> DataFrame:
        """``(cell, component, cluster_id, size)``: cells with their component, of those with at least so many records."""
        cc = connected_components(self._cell_links(), "a", "b")
        cells = self._named().join(cc.select(F.col("id").alias("cell"), "component"), "cell", "left")
        cells = cells.withColumn("component", F.coalesce("component", "cell"))
        size = cells.groupBy("component").agg(F.sum("n").alias("size"), F.min("least").alias("cluster_id")).where(F.col("size") >= least_size)
        return cells.select(*self.cells, "cell", "n", "component").join(size, "component")

    def membership(self, least_size: int = 1) -> DataFrame:
        """``(id, cluster_id)``: the records of clusters with at least so many, cluster_id being the least id."""
        return self.records.join(self.components(least_size).select(*self.cells, "cluster_id"), self.cells).select("id", "cluster_id").distinct()

    def describe(self, least_size: int = 1, typical: int = 3, loose: float = 0.5) -> DataFrame:
        """One row per cluster: ``(cluster_id, part, size, is_loose, typical)``, loose ones split around medoids.

        A cell's degree is the number of records in it and in the cells linked to it. A component is loose if its
        highest degree is below ``loose`` of its size. In a loose one each cell goes to its neighbour of highest degree
        (itself, if none is higher; ties to the smaller cell), and on from there, until a local summit, the medoid cell
        of a part; a tight one is a single part around its highest-degree cell. Part sizes add up to the component's.
        ``typical`` are the ids nearest the medoid cell's centre of gravity, ties by id.
        """
        comp = cut(self.components(least_size), "components")
        link = self._cell_links()
        both = link.union(link.select("b", "a")).join(comp.select(F.col("cell").alias("b"), F.col("n").alias("nb")), "b")
        degree = both.groupBy(F.col("a").alias("cell")).agg(F.sum("nb").alias("around"))
        comp = cut(comp.join(degree, "cell", "left").withColumn("degree", F.col("n") + F.coalesce("around", F.lit(0))), "degrees")
        rank = lambda d, c: F.struct((-F.col(d)).alias("d"), F.col(c).alias("cell"))
        top = comp.groupBy("component").agg(F.min(rank("degree", "cell")).alias("t"), F.max("degree").alias("most"), F.first("size").alias("whole"))
        top = top.select("component", F.col("t.cell").alias("summit"), (F.col("most") < F.lit(loose) * F.col("whole")).alias("is_loose"))
        up = both.select("a", "b").join(comp.select(F.col("cell").alias("b"), F.col("degree").alias("db")), "b")
        up = up.groupBy(F.col("a").alias("cell")).agg(F.min(rank("db", "b")).alias("up"))
        tree = comp.join(top, "component").join(up, "cell", "left")
        own = rank("degree", "cell")
        climb = F.when(~F.col("is_loose"), F.col("summit")).when(F.col("up") < own, F.col("up.cell")).otherwise(F.col("cell"))
        tree = cut(tree.withColumn("to", climb), "climb")
        while True:
            hop = tree.select(F.col("cell").alias("to"), F.col("to").alias("next"))
            new = cut(tree.join(hop, "to").withColumn("moved", F.col("next") != F.col("to")).drop("to").withColumnRenamed("next", "to"), "climb")
            moved = new.where("moved").limit(1).count()
            tree = new.drop("moved")
            if not moved:
                break
        parts = tree.groupBy("cluster_id", "to").agg(F.sum("n").alias("size"), F.max("is_loose").alias("is_loose"))
        summit = self.records.join(tree.where("cell = to").select(*self.cells, "to"), self.cells)
        centre = summit.groupBy("to").agg(*[F.avg(x).alias(f"m_{x}") for x in self.values])
        far = sum(F.pow((F.col(x) - F.col(f"m_{x}")) / F.lit(float(w)), 2) for x, w in zip(self.values, self.widths))
        near = summit.join(centre, "to").select("to", "id", far.alias("far")).groupBy("to", "id").agg(F.min("far").alias("far"))
        near = near.withColumn("r", F.row_number().over(Window.partitionBy("to").orderBy("far", "id"))).where(F.col("r") <= typical)
        near = near.groupBy("to").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "id"))), lambda s: s["id"]).alias("typical"))
        return parts.join(near, "to").select("cluster_id", F.col("to").alias("part"), "size", "is_loose", "typical")
