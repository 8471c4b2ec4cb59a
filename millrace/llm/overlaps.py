"""Same or nearly same texts on two sides, by winnowing fingerprints.

Of the rolling hashes of a text's k-grams the least of every window of w is selected (the rightmost of equal ones).
Two texts that share a run of at least w + k - 1 characters share a selected fingerprint, whatever surrounds it, so
joining the selected hashes of both sides misses no such pair. The seeds of a pair are chained where they are collinear,
extended by alignment over the characters between and around them, and the matched characters give the coverage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.runtime import cut

#: fixed value: an odd multiplier, so that its powers can be inverted modulo 2^64
BASE = 0x9E3779B97F4A7C15
#: Mismatches in a row after which an extension ends.
BREAK = 8


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def winnow(texts: list[str], k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place and hash of every selected fingerprint of a batch of texts.

    A text of fewer than k characters has one, of the whole of it; a text of fewer than w k-grams has its least.
    """
    size = np.array([len(t) for t in texts], np.int64)
    owner: list[np.ndarray] = []
    place: list[np.ndarray] = []
    value: list[np.ndarray] = []
    for i in np.flatnonzero((size > 0) & (size < k)):
        h = np.uint64(size[i])
        for c in texts[i]:
            h = np.uint64((int(h) * BASE + ord(c) + 1) & (2**64 - 1))
        owner.append(np.array([i])), place.append(np.array([0])), value.append(_mix(np.array([h], np.uint64)))
    long = np.flatnonzero(size >= k)
    if len(long):
        codes = np.frombuffer("".join(texts[i] for i in long).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        n = len(codes)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, BASE, np.uint64))))
            back = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, pow(BASE, -1, 2**64), np.uint64))))
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * power[:-1])))
            grams = _mix((total[k:] - total[:-k]) * back[: n - k + 1])
        begin = np.cumsum(size[long]) - size[long]
        count = size[long] - k + 1  # k-grams of each text
        window = np.minimum(count, w)
        # the windows of each text, by their first k-gram
        wins = count - window + 1
        first = np.repeat(begin, wins) + np.arange(wins.sum()) - np.repeat(np.cumsum(wins) - wins, wins)
        reach = np.repeat(window, wins)
        best = first.copy()
        least = grams[first]
        for step in range(1, w):
            at = np.minimum(first + step, len(grams) - 1)
            better = (step < reach) & (grams[at] <= least)
            best[better], least[better] = at[better], grams[at][better]
        row = np.repeat(np.arange(len(long)), wins)
        fresh = np.concatenate(([True], (best[1:] != best[:-1]) | (row[1:] != row[:-1])))
        best, row = best[fresh], row[fresh]
        owner.append(long[row]), place.append(best - begin[row]), value.append(grams[best])
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owner), np.concatenate(place), np.concatenate(value)


def fingerprints(texts: DataFrame, k: int, w: int) -> DataFrame:
    """``(id, place, hash)`` of the selected fingerprints of texts (id, text): only ids go on, not the texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            owner, place, value = winnow(b["text"].tolist(), k, w)
            yield pd.DataFrame({"id": b["id"].to_numpy(np.int64)[owner], "place": place.astype(np.int32), "hash": value.view(np.int64)})

    return texts.select("id", "text").mapInPandas(run, "id bigint, place int, hash bigint")


def align(a: str, b: str, seeds: list[tuple[int, int]], k: int) -> tuple[int, int]:
    """Number of seeds chained, and of characters matched, for seeds (place in a, place in b); those whose k characters differ are left out."""
    seeds = sorted({(p, q) for p, q in seeds if a[p : p + k] == b[q : q + k]})
    if not seeds:
        return 0, 0
    # the longest collinear chain: places grow on both sides
    tails: list[int] = []
    at: list[int] = []
    link: list[int] = []
    for i, (_, q) in enumerate(seeds):
        p = bisect_left(tails, q)
        if p == len(tails):
            tails.append(q), at.append(i)
        else:
            tails[p], at[p] = q, i
        link.append(at[p - 1] if p else -1)
    chain, i = [], at[-1]
    while i >= 0:
        chain.append(seeds[i])
        i = link[i]
    chain.reverse()
    matched, p, q = 0, 0, 0
    for s, t in chain:
        if s < p or t < q:  # overlaps the one before: only what lies beyond counts
            d = max(p - s, q - t)
            n = max(0, k - d)
            matched += n
            p, q = p + n, q + n
            continue
        gap = min(s - p, t - q)
        if s - p == t - q:
            matched += sum(x == y for x, y in zip(a[p:s], b[q:t]))
        else:  # from either end along its own diagonal, until it breaks
            left = _run(a[p : p + gap], b[q : q + gap])
            right = _run(a[s - gap : s][::-1], b[t - gap : t][::-1])
            matched += min(gap, left + right)
        matched += k
        p, q = s + k, t + k
    matched += _run(a[p:], b[q:])
    return len(chain), matched


def _run(x: str, y: str) -> int:
    """Characters matched along a diagonal until ``BREAK`` mismatches in a row."""
    n = miss = 0
    for c, d in zip(x, y):
        if c == d:
            n, miss = n + 1, 0
        else:
            miss += 1
            if miss == BREAK:
                break
    return n


def equal_texts(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(a, b, seeds, matched, coverage)`` of the texts that both sides (text) hold; null and empty ones overlap nothing."""
    a = left.select("text").where("text <> ''").distinct()
    b = right.select("text").where("text <> ''").distinct()
    return a.join(b, "text").select(F.col("text").alias("a"), F.col("text").alias("b"), F.lit(0).alias("seeds"), F.length("text").alias("matched"), F.lit(1.0).alias("coverage"))


def text_overlaps(left: DataFrame, right: DataFrame, k: int, w: int, least: float, in_place: bool = False) -> DataFrame:
    """``(a, b, seeds, matched, coverage)`` of the distinct texts of ``left`` and ``right`` (text) that overlap.

    coverage is the share of the longer text that is matched, and at least ``least``. Equal texts have coverage 1 and are found by an equality join beside the fingerprints.
    ``in_place`` keeps only seeds at the same place on both sides, for texts that differ by substitutions alone. Null and
    empty texts overlap nothing; either side empty gives no rows.

    A text goes by a 64-bit number until its pairs are known, so that what is shuffled by fingerprint is of fixed width
    whatever the texts' length; where two texts have one number, each is aligned. The join by hash (and place) is a
    plain one that adaptive execution splits where a fingerprint is common.
    """
    named = lambda df: df.select("text").where("text <> ''").distinct().select(F.xxhash64("text").alias("id"), "text")
    a, b = named(left), named(right)
    fa = fingerprints(a, k, w).toDF("ia", "p", "hash")
    fb = fingerprints(b, k, w).toDF("ib", "q", "hash")
    on = (fa["hash"] == fb["hash"]) & (F.col("ia") != F.col("ib"))
    if in_place:
        on = on & (F.col("p") == F.col("q"))
    seeds = fa.join(fb, on).groupBy("ia", "ib").agg(F.collect_set(F.struct("p", "q")).alias("at"))
    seeds = seeds.join(a.toDF("ia", "a"), "ia").join(b.toDF("ib", "b"), "ib").select("a", "b", "at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = []
            for x, y, at in zip(t["a"], t["b"], t["at"]):
                n, m = align(x, y, [(s["p"], s["q"]) for s in at], min(k, len(x), len(y)))
                rows.append((x, y, n, m, m / max(len(x), len(y))))
            yield pd.DataFrame(rows, columns=["a", "b", "seeds", "matched", "coverage"])

    near = seeds.mapInPandas(run, "a string, b string, seeds int, matched int, coverage double").where(F.col("coverage") >= least)
    return cut(equal_texts(a, b).unionByName(near), "overlaps")


def expand(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of texts as pairs of the records (id, text, ...) that hold them: ``(a_*, b_*)`` with all their columns."""
    la = left.select([F.col(c).alias(f"a_{c}") for c in left.columns])
    rb = right.select([F.col(c).alias(f"b_{c}") for c in right.columns])
    return pairs.join(la, F.col("a") == F.col("a_text")).join(rb, F.col("b") == F.col("b_text"))
