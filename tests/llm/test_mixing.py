import random

import pytest

from millrace.llm import mixing
from tests.conftest import rows


def make(spark, sizes):
    rnd = random.Random(1)
    recs, k = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            recs.append((k, s, rnd.choice([0, 10, 20, 300]), 5))
            k += 1
    recs += [(k, None, 10, 5), (k + 1, "unknown", 10, 5), (None, "a", 7, 5)]
    return spark.createDataFrame(recs, "key bigint, source string, size bigint, repeats int")


def test_shares_are_met(spark):
    df = make(spark, {"a": 6000, "b": 700, "c": 900}).select("key", "source", "size")
    m = mixing.Mix(df, {"a": (0.5, 1), "b": (0.3, 4), "c": (0.21, 2), "gone": (0.2, 3)})
    got = {r["source"]: r for r in m.shares().collect()}
    assert got["gone"]["actual_share"] == 0 and got["gone"]["scaled_share"] == 0
    for s in "abc":
        r = got[s]
        assert abs(r["actual_share"] - r["scaled_share"]) * sum(x["mixed_tokens"] for x in got.values()) < 700
        assert r["repeats"] <= r["max_repeats"]
    chosen = m.chosen.collect()
    for s in "abc":
        assert {r["repeats"] for r in chosen if r["source"] == s} <= {m.passes[s], m.passes[s] + 1}
    assert rows(m.chosen) == rows(mixing.Mix(df.repartition(9), m.targets).chosen)


def test_capped_source_stays_below(spark):
    df = make(spark, {"a": 2000, "b": 20}).select("key", "source", "size")
    m = mixing.Mix(df, {"a": (0.5, 1), "b": (0.5, 2)}, total=20_000)
    got = {r["source"]: r for r in m.shares().collect()}
    assert got["b"]["repeats"] == 2 and got["b"]["actual_share"] < 0.5


def test_threshold_is_within_one_record(spark):
    df = make(spark, {"a": 5000}).select("key", "source", "size")
    for total in (1, 299, 1000, 123_456):
        m = mixing.Mix(df, {"a": (1.0, 3)}, total=total)
        got = sum(r["size"] * r["repeats"] for r in m.chosen.collect())
        assert abs(got - total) <= 300


def test_empty(spark):
    df = spark.createDataFrame([], "key bigint, source string, size bigint")
    m = mixing.Mix(df, {"a": (1.0, 1)})
    assert rows(m.chosen) == [] and [r["actual_share"] for r in m.shares().collect()] == [0.0]


def test_targets(spark):
    df = spark.createDataFrame([(" A ", 0.1, 3), ("a", 0.2, 1), ("a", 0.2, 1), (None, 1.0, 1), ("b", None, None)], "source string, target_share double, max_repeats int")
    t = mixing.read_targets(df)
    assert set(t) == {"a", "b"} and t["a"] == (pytest.approx(0.3), 1) and t["b"] == (0.0, 1)


def test_more_targets_than_ten_thousand(spark):
    df = spark.range(10_002).selectExpr("concat('s', id) AS source", "1.0D AS target_share", "1 AS max_repeats")
    assert len(mixing.read_targets(df)) == 10_002
