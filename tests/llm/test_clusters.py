from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import clusters
from tests.conftest import rows

TOL = {"c": 30.0, "r": 0.004, "z": 0.003, "b": 30.0}
SHAPE = "audio_id string, c double, r double, z double, b double, c0 int, x0 int, id int"


def brute(recs, least):
    recs = sorted({r[:5] for r in recs if r[0] is not None and all(v is not None and np.isfinite(v) for v in r[1:5])})
    x, w = np.array([r[1:] for r in recs]), np.array(list(TOL.values()))
    parent = list(range(len(recs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(recs)):
        for j in np.flatnonzero((np.abs(x[i + 1 :] - x[i]) <= w).all(1)) + i + 1:
            parent[find(int(j))] = find(i)
    groups = defaultdict(list)
    for i, r in enumerate(recs):
        groups[find(i)].append(r[0])
    return sorted({(i, min(g)) for g in groups.values() if len(g) >= least for i in g}, key=repr)


def make(seed, n, spread):
    rnd = np.random.default_rng(seed)
    centres = rnd.uniform([500, 0.01, 0.01, 500], [5000, 0.4, 0.4, 4000], (12, 4))
    out = []
    for i in range(n):
        x = centres[min(int(rnd.exponential(2)), 11)] + rnd.normal(0, spread, 4) * np.array(list(TOL.values()))
        out.append((f"a{i:05}", *map(float, x), 1, 2, 3))
    return out


@pytest.mark.parametrize("spread", [0.4, 1.5, 4.0])
def test_membership_against_brute_force(spark, spread):
    data = make(3, 900, spread)
    data += data[:50]
    data += [(f"v{i}", 1e300 * (1 + i % 2), 0.1, -0.1, 1e18, 1, 1, 1) for i in range(12)]
    data += [("n1", None, 0.1, 0.1, 1.0, 1, 1, 1), ("n2", float("nan"), 0.1, 0.1, 1.0, 1, 1, 1), ("n3", 1.0, float("inf"), 0.1, 1.0, 1, 1, 1), (None, *data[0][1:])]
    df = spark.createDataFrame(data, SHAPE)
    assert rows(clusters.Clusters(df, "audio_id", TOL).membership(5)) == brute(data, 5)


def test_ties_and_exact_distance(spark):
    step = [("s%d" % i, 30.0 * i, 0.0, 0.0, 0.0, 1, 1, 1) for i in range(6)]  # each exactly one tolerance from the next
    far = [("t%d" % i, 1000.0 + 30.5 * i, 0.0, 0.0, 0.0, 1, 1, 1) for i in range(6)]
    df = spark.createDataFrame(step + far, SHAPE)
    assert rows(clusters.Clusters(df, "audio_id", TOL).membership(5)) == [(f"s{i}", "s0") for i in range(6)]


def test_hot_cell_links_through_its_border(spark):
    """A cell of many records and one neighbour that only its outermost record reaches."""
    rnd = np.random.default_rng(1)
    hot = [(f"h{i:04}", *map(float, 300 + rnd.uniform(0, 20, 1)), *map(float, rnd.uniform(0.0001, 0.0039, 1)), *map(float, rnd.uniform(0.0001, 0.0029, 1)), 5.0, 1, 1, 1) for i in range(3000)]
    edge = [("edge", 329.0, 0.002, 0.0015, 5.0, 1, 1, 1), ("out", 358.9, 0.0055, 0.0015, 5.0, 1, 1, 1)]
    got = rows(clusters.Clusters(spark.createDataFrame(hot + edge, SHAPE), "audio_id", TOL).membership(5))
    assert len(got) == 3002 and {c for _, c in got} == {"edge"}


def test_empty(spark):
    df = spark.createDataFrame([], SHAPE)
    c = clusters.Clusters(df, "audio_id", TOL)
    assert rows(c.membership(1)) == [] and rows(c.describe(1)) == []


def test_describe_splits_loose_ones(spark):
    data = make(5, 600, 1.2)
    df = spark.createDataFrame(data, SHAPE)
    c = clusters.Clusters(df, "audio_id", TOL)
    parts = c.describe(5).collect()
    sizes = defaultdict(int)
    for p in parts:
        sizes[p["cluster_id"]] += p["size"]
        assert 1 <= len(p["typical"]) <= 3
    whole = defaultdict(int)
    for _, cid in brute(data, 5):
        whole[cid] += 1
    assert sizes == whole
    assert any(p["is_loose"] for p in parts)


def test_skyline():
    rnd = np.random.default_rng(0)
    x = np.round(rnd.uniform(0, 1, (300, 4)), 1)
    kept = x[clusters.skyline(x)]
    for p in x:
        assert ((kept >= p).all(1)).any()


def test_bands_cover_every_pair_of_enough_tokens():
    """Whatever k - f of the k tokens two cells share, they share two of some band; Jaccard rejects those with fewer."""
    from itertools import combinations

    for k, f in ((8, 4), (6, 4), (9, 3), (5, 2), (3, 1)):
        keyed = clusters.bands(k, f)
        for shared in combinations(range(k), k - f):
            assert any(g in shared and h in shared for g, h in keyed)


def test_jaccard_rejects_candidates_of_one_band():
    """Two cells that meet under a key but are further than a tolerance apart in every field: 2 of 8 tokens are too few."""
    cells, values = ["c0", "c1", "c2", "c3"], ["x0", "x1", "x2", "x3"]
    rnd = np.random.default_rng(4)
    rejected = 0
    for _ in range(300):
        u = rnd.integers(-20, 20, 4)
        v = u + rnd.integers(-4, 5, 4)
        tokens = [((u + t) // 8 == (v + t) // 8).all() for t in range(8)]
        met = any(tokens[g] and tokens[h] for g, h in clusters.bands(8, 4))
        enough = sum(tokens) * 12 >= 4 * (16 - sum(tokens))
        if np.abs(u - v).max() <= 1:
            assert met and enough
        rejected += met and not enough
    assert rejected > 0
