import random
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.llm import splits
from tests.conftest import rows


def groups(spark, pairs):
    df = spark.createDataFrame([(t, a, 0, "") for t, a in pairs], "track_id string, artist_id string, label int, entity string")
    return {r["record"]: r["group"] for r in splits.entity_groups(splits.record_entities(df, "track_id", splits.number_in(F.col("artist_id")))).collect()}


def test_artist_forms(spark):
    got = groups(spark, [("a", "artist_007"), ("a", "artist_007"), ("b", " ARTIST-7 "), ("c", "Artist 0007"), ("d", "various"), ("e", None), ("f", ""), (None, "artist_7"), ("g", "artist_9")])
    assert got == {"a": 7, "b": 7, "c": 7, "g": 9}


def test_long_chain_and_hub(spark):
    rnd = random.Random(3)
    ids = rnd.sample(range(1, 10_000), 300)
    chain = [(f"t{i}", str(x)) for i in range(299) for x in ids[i : i + 2]]
    hub = [(f"h{i}", "20000") for i in range(500)] + [(f"h{i}", str(30000 + i)) for i in range(50)]
    got = groups(spark, chain + hub)
    assert {got[f"t{i}"] for i in range(299)} == {min(ids)}
    assert {got[f"h{i}"] for i in range(500)} == {20000}


def test_random_against_brute_force(spark):
    rnd = random.Random(9)
    pairs = [(f"t{rnd.randint(0, 150)}", str(rnd.randint(1, 220))) for _ in range(260)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for t, a in pairs:
        parent[find(("t", t))] = find(("a", int(a)))
    low = defaultdict(lambda: 10**9)
    for _, a in pairs:
        low[find(("a", int(a)))] = min(low[find(("a", int(a)))], int(a))
    assert groups(spark, pairs) == {t: low[find(("t", t))] for t, _ in pairs}


def test_empty(spark):
    assert groups(spark, []) == {}
    none = spark.createDataFrame([], "unit string, label string, n bigint")
    assert rows(splits.assign(none, {"a": 1, "b": 1})) == []


def test_assignment_keeps_shares(spark):
    rnd = random.Random(7)
    units = []
    for i in range(3000):
        lab = rnd.choice(["x", "x", "x", "y", None])
        units.append((f"u{i}", lab, rnd.choice([1, 1, 1, 2, 5])))
    units += [("huge", "x", 900), ("big", "y", 300), ("big", "x", 100), *[(f"m{i}", "y", 40) for i in range(12)]]
    df = spark.createDataFrame([(*u, 1) for u in units], "unit string, label string, n bigint, size int")
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    got = dict(rows(splits.assign(df, shares)))
    assert set(got) == {u for u, _, _ in units}
    assert got == dict(rows(splits.assign(df.repartition(7), shares)))
    total = sum(n for _, _, n in units)
    for s, w in shares.items():
        assert abs(sum(n for u, _, n in units if got[u] == s) / total - w) < 0.01
        for lab in ("x", "y", None):
            of = sum(n for _, x, n in units if x == lab)
            assert abs(sum(n for u, x, n in units if got[u] == s and x == lab) / of - w) < 0.03


def test_units_of_mixed_labels_and_very_many_labels(spark):
    """Each unit holds several labels; 300 labels beside a few frequent ones, each of which reaches every split."""
    rnd = random.Random(3)
    rows_in = []
    for i in range(4000):
        for lab in set(rnd.choices(["a", "b", "c", "d"], k=rnd.randint(1, 3))):
            rows_in.append((f"u{i}", lab, rnd.randint(1, 3)))
    rows_in += [(f"r{i}", f"rare{i % 300}", 1) for i in range(9000)]
    rows_in += [("h1", "a", 400), ("h1", "b", 200), ("h1", "rare1", 1), ("h2", "c", 350)]
    df = spark.createDataFrame(rows_in, "unit string, label string, n bigint")
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    got = dict(rows(splits.assign(df, shares)))
    assert set(got) == {u for u, _, _ in rows_in}
    total, per = defaultdict(int), defaultdict(int)
    for u, lab, n in rows_in:
        total[lab] += n
        per[lab, got[u]] += n
    for lab in total:
        for s, w in shares.items():
            assert abs(per[lab, s] / total[lab] - w) < (0.02 if lab in "abcd" else 0.11), (lab, s)
    rare = [lab for lab in total if lab not in "abcd"]
    assert sum(per[lab, s] > 0 for lab in rare for s in shares) > 0.95 * 3 * len(rare)
