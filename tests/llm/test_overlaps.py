import random

import pytest

from millrace.llm import overlaps, queries
from tests.conftest import rows

HEX = "0123456789abcdef"


def test_winnow_guarantee():
    """Any two texts that share a run of w + k - 1 characters share a fingerprint."""
    rnd = random.Random(2)
    for _ in range(200):
        k, w = rnd.randint(1, 8), rnd.randint(1, 8)
        shared = "".join(rnd.choice("ab") for _ in range(k + w - 1))
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 30))) + shared + "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 30)))
        b = "".join(rnd.choice("abd") for _ in range(rnd.randint(0, 30))) + shared
        owner, _, value = overlaps.winnow([a, "x", b], k, w)
        assert set(value[owner == 0]) & set(value[owner == 2])


def test_winnow_batches_are_independent():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(HEX) for _ in range(rnd.randint(0, 90))) for _ in range(30)]
    owner, place, value = overlaps.winnow(texts, 5, 4)
    for i, t in enumerate(texts):
        o, p, v = overlaps.winnow([t], 5, 4)
        assert list(zip(p, v)) == list(zip(place[owner == i], value[owner == i]))


@pytest.mark.parametrize("seed", [1, 2])
def test_two_substitutions_are_always_found(spark, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(HEX) for _ in range(64)) for _ in range(60)]
    right, want = list(base), {(b, b) for b in base}
    for b in base:
        t = list(b)
        for at in rnd.sample(range(64), rnd.choice([1, 2, 3])):
            t[at] = rnd.choice([c for c in HEX if c != t[at]])
        right.append("".join(t))
        if sum(x != y for x, y in zip(b, t)) <= 2:
            want.add((b, "".join(t)))
    shape = "text string, a string, b string"
    left_df = spark.createDataFrame([(b, "", "") for b in base + [None, ""] + base[:3]], shape)
    right_df = spark.createDataFrame([(b, "", "") for b in right + [None, ""]], shape)
    got = overlaps.text_overlaps(left_df, right_df, 16, 6, 62 / 64, in_place=True)
    assert {(r["a"], r["b"]) for r in got.collect()} == want


def test_long_texts_with_insertions(spark):
    rnd = random.Random(5)
    doc = " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(4000))
    other = doc[:9000] + " something was put in here " + doc[9000:20000] + doc[20100:]
    left = spark.createDataFrame([(doc,), ("short",)], "text string")
    right = spark.createDataFrame([(other,), ("short",), ("nothing alike at all, of another length",)], "text string")
    got = {(r["a"] == doc, r["b"] == other): r for r in overlaps.text_overlaps(left, right, 20, 30, 0.8).collect()}
    assert set(got) == {(True, True), (False, False)}
    assert got[True, True]["coverage"] > 0.99


def test_empty_sides(spark):
    some, none = spark.createDataFrame([("abc",)], "text string"), spark.createDataFrame([], "text string")
    for a, b in ((some, none), (none, some), (none, none)):
        assert rows(overlaps.text_overlaps(a, b, 3, 2, 0.5)) == []


def test_equal_ids_take_no_fingerprints(spark, tmp_path, monkeypatch):
    ids = [("x-O1", "train", None), ("X01", "val", "p"), ("x02", "test", "p"), (None, "val", "p")]
    spark.createDataFrame(ids, "audio_id string, split_name string, pool string").write.parquet(f"{tmp_path}/split_ids.parquet")
    spark.createDataFrame([("x-O1", "ab" * 32), ("x02", "ab" * 31 + "cc")], "audio_id string, sha256 string").write.parquet(f"{tmp_path}/audio_manifest.parquet")
    made, fingerprints = [], overlaps.fingerprints
    monkeypatch.setattr(overlaps, "fingerprints", lambda texts, k, w: made.append(k) or fingerprints(texts, k, w))
    assert rows(queries.p5_found(spark, str(tmp_path))) == [("X01", "x-O1", "val"), ("x-O1", "x02", "test")]
    assert made == [12, 12]  # those of the hashes


def test_align_counts_matches():
    a = "x" * 10 + "abcdefghij" + "yy"
    b = "z" * 3 + "abcdefghij" + "yy"
    seeds = [(10 + i, 3 + i) for i in range(7)]
    assert overlaps.align(a, b, seeds, 4) == (7, 12)
    assert overlaps.align(a, b, [*seeds, (0, 0)], 4) == (7, 12)  # of other texts with the same number
    assert overlaps.align(a, b, [(0, 0)], 4) == (0, 0)
