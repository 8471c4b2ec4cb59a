import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import increments, queries
from tests.conftest import rows

HEX = "0123456789abcdef"
SHAPE = "id string, ts timestamp, sha string, bytes bigint"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def hamming(a, b):
    return sum(x != y for x, y in zip(a, b)) if len(a) == len(b) else 99


@pytest.mark.parametrize("substitutions, crowded", [(True, 500), (True, 2), (False, 500)])
def test_near_strings_against_brute_force(spark, substitutions, crowded):
    rnd = random.Random(6)
    base = ["".join(rnd.choice("ab") for _ in range(18)) for _ in range(25)]
    s = set(base)
    for b in base:
        t = list(b)
        for _ in range(rnd.randint(1, 3)):
            at = rnd.randrange(len(t))
            what = rnd.choice("sid" if not substitutions else "s")
            t[at : at + 1] = {"s": [rnd.choice("abc")], "i": [t[at], rnd.choice("abc")], "d": []}[what]
        s.add("".join(t))
    s = sorted(s)
    dist = hamming if substitutions else levenshtein
    want = [(a, b) for i, a in enumerate(s) for b in s[i + 1 :] if dist(a, b) <= 2]
    df = spark.createDataFrame([(x,) for x in s], "s string")
    assert rows(increments.near_strings(df, None, 2, substitutions, crowded)) == want
    # half of them stored: the pairs with a new one
    old, new = s[::2], s[1::2]
    stored = increments.segments(spark.createDataFrame([(x,) for x in old], "s string"), 2)
    got = rows(increments.near_strings(spark.createDataFrame([(x,) for x in new], "s string"), stored, 2, substitutions, crowded))
    assert got == [p for p in want if p[0] in new or p[1] in new]


def brute(recs):
    accepted, out = [], set()
    for i, ts, sha, size in sorted(set(recs), key=lambda r: (r[1], r[0])):
        if not sha:
            continue
        hit = None
        for j, o, b in accepted:
            near = size is not None and b is not None and len(sha) == len(o) == 64 and abs(size - b) <= 64 and hamming(sha, o) <= 2
            p, q = sorted((sha, o), key=len)
            cut = size is not None and size == b and 16 <= len(p) < len(q) and q.startswith(p)
            if sha == o or near or cut:
                hit = j
                break
        if hit is None:
            accepted.append((i, sha, size))
        else:
            out.add((i, hit))
    return sorted(out)


def make(seed, n=160, days=5):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(HEX) for _ in range(64)) for _ in range(n // 8)]
    out = []
    for i in range(n):
        s, size = rnd.choice(base), rnd.choice([1000, 1000, 1040, 1100, 1164, None])
        kind = rnd.random()
        if kind < 0.45:
            t = list(s)
            for at in rnd.sample(range(64), rnd.choice([1, 1, 2])):
                t[at] = rnd.choice(HEX)
            s = "".join(t)
        elif kind < 0.65:
            s = s[: rnd.choice([8, 15, 16, 17, 40, 63])]
        elif kind < 0.7:
            s = rnd.choice([None, ""])
        out.append((f"r{rnd.randint(0, 10**6):07}", dt.datetime(2025, 1, 1 + rnd.randint(0, days)), s, size))
    return out + out[:9]


@pytest.mark.parametrize("seed", [1, 2])
def test_bulk_against_brute_force(spark, seed):
    recs = make(seed)
    df = spark.createDataFrame(recs, SHAPE).distinct()
    assert rows(increments.rejected(df, increments.decide(increments.classes_of(df)))) == brute(recs)


def test_batches_against_bulk(spark, tmp_path):
    recs = make(4, days=2)
    h = increments.History(str(tmp_path))
    got = []
    for day in sorted({r[1] for r in recs}):
        got += rows(h.add(spark.createDataFrame([r for r in recs if r[1] == day], SHAPE).distinct()))
    assert sorted(got) == brute(recs)


def test_stored_history_is_found_again(spark, tmp_path):
    """A new object for every batch, and every batch twice, as after a lost driver."""
    recs = make(4, 100, days=1)
    (tmp_path / "index" / "run=1" / "_temporary").mkdir(parents=True)  # a first write that ended early
    got = []
    for day in sorted({r[1] for r in recs}):
        df = spark.createDataFrame([r for r in recs if r[1] == day], SHAPE).distinct()
        once = rows(increments.History(str(tmp_path)).add(df))
        stored = spark.read.parquet(f"{tmp_path}/classes").count()
        assert rows(increments.History(str(tmp_path)).add(df)) == once
        assert spark.read.parquet(f"{tmp_path}/classes").count() == stored
        got += once
    assert sorted(got) == brute(recs)


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    t, day = dt.datetime(2025, 1, 1), dt.timedelta(days=1)
    rnd = random.Random(8)
    old = [(f"o{i}", t, "".join(rnd.choice(HEX) for _ in range(64)), i) for i in range(400)]
    h = increments.History(str(tmp_path), buckets=256)
    assert rows(h.add(spark.createDataFrame(old, SHAPE))) == []
    new = [("x", t + day, old[7][2][:-1] + ("1" if old[7][2][-1] == "0" else "0"), 50)]
    df = spark.createDataFrame(new, SHAPE)
    read = h.index(increments.classes_of(df))
    assert read.count() < 400 * 8 / 10  # 8 keys at most, so 8 of 256 buckets
    assert 0 < read.join(increments.entries(increments.classes_of(df)), "key", "left_semi").count() <= 8
    assert rows(h.add(df)) == [("x", "o7")]
    h.compact(spark, buckets=16)
    assert sorted(p.name for p in tmp_path.glob("index/run=*")) == ["run=3"]
    assert rows(increments.History(str(tmp_path)).add(spark.createDataFrame([("y", t + day * 2, old[9][2], None), ("z", t + day * 2, old[3][2][:30], 3)], SHAPE))) == [("y", "o9"), ("z", "o3")]


def test_what_matches(spark):
    t = dt.datetime(2025, 1, 1)
    old = [("same", t, "ab" * 32, 5), ("near", t, "cd" * 32, 9000), ("head", t, "ef" * 20, 7), ("size", t, "ef" * 19, 8), ("none", t, "12" * 32, 5), ("none2", t, "ab" * 7, None)]
    new = [("x", t + dt.timedelta(1), "ab" * 32, None), ("y", t + dt.timedelta(1), "cd" * 31 + "ce", 9064), ("z", t + dt.timedelta(1), "ef" * 32, 7), ("u", t + dt.timedelta(1), "cd" * 31 + "cf", 9065)]
    old, new = (increments.classes_of(spark.createDataFrame(x, SHAPE)) for x in (old, new))
    for crowded in (500, 1):
        got = increments.matches(new, increments.entries(old), old, crowded).where("old").join(new.select(F.col("cid").alias("late"), F.col("first.id").alias("id")), "late")
        assert rows(got.select("id", "first.id")) == [("x", "same"), ("y", "near"), ("z", "head")]


@pytest.mark.parametrize("crowded", [1])
def test_crowded_keys_against_brute_force(spark, crowded):
    recs = make(11, 120)
    df = spark.createDataFrame(recs, SHAPE).distinct()
    assert rows(increments.rejected(df, increments.decide(increments.classes_of(df), crowded=crowded))) == brute(recs)


def test_query_by_steps(spark, tmp_path):
    """The registered query goes through stored history, and finds what one pass over all finds."""
    recs = make(12, 150)
    spark.createDataFrame([(i, s, b, t) for i, t, s, b in recs], "audio_id string, sha256 string, file_bytes bigint, import_timestamp timestamp").write.parquet(f"{tmp_path}/audio_manifest.parquet")
    assert rows(queries.p7_found(spark, str(tmp_path))) == sorted({(min(p), max(p)) for p in brute(recs)})
    old = "ab" * 32
    recs = [("r0", None, "12" * 32, 5), ("r1", dt.datetime(2025, 12, 1), "12" * 32, 5), ("r2", dt.datetime(2025, 12, 2), old, 5), ("r3", dt.datetime(2025, 12, 2), old[:20], 5)]
    spark.createDataFrame([(i, s, b, t) for i, t, s, b in recs], "audio_id string, sha256 string, file_bytes bigint, import_timestamp timestamp").write.parquet(f"{tmp_path}/two/audio_manifest.parquet")
    assert rows(queries.p7_found(spark, f"{tmp_path}/two")) == [("r0", "r1"), ("r2", "r3")]
    spark.createDataFrame([], "audio_id string, sha256 string, file_bytes bigint, import_timestamp timestamp").write.parquet(f"{tmp_path}/none/audio_manifest.parquet")
    assert rows(queries.p7_found(spark, f"{tmp_path}/none")) == []


def test_one_hash_with_many_sizes(spark):
    recs = [(f"a{i:04}", dt.datetime(2025, 1, 1), "ab" * 32, i * 1000) for i in range(400)]
    df = spark.createDataFrame(recs, SHAPE)
    assert rows(increments.rejected(df, increments.decide(increments.classes_of(df)))) == [(f"a{i:04}", "a0000") for i in range(1, 400)]


def test_empty_and_nulls(spark):
    for recs in ([], [("a", None, None, None), ("b", None, "", 3)]):
        df = spark.createDataFrame(recs, SHAPE)
        assert rows(increments.rejected(df, increments.decide(increments.classes_of(df)))) == []
    recs = [("a", None, "x", None), ("b", dt.datetime(2025, 1, 1), "x", None)]  # a null time comes first
    df = spark.createDataFrame(recs, SHAPE).withColumn("bytes", F.col("bytes"))
    assert rows(increments.rejected(df, increments.decide(increments.classes_of(df)))) == [("b", "a")]
