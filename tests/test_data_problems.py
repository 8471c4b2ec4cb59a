"""Copies compared, intervals merged, packed fields split: brute force and the hard cases."""

import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.strings import folded
from millrace.operators import diff, intervals, packed
from tests.conftest import rows

SUMS = "audio_id string, sha string, path string, size bigint, ts int, k string, side int, s string"


def compare(a, b):
    return rows(diff.diff_copies(a, b, "audio_id", ("sha", "path", "size"), "ts", {"sha": folded, "path": diff.styled_path}))


def test_diff_cases(spark):
    a = spark.createDataFrame(
        [
            ("same", " AB\t", "./x//y\\z ", 1, 1, "", 0, ""),
            ("same", " AB\t", "./x//y\\z ", 1, 1, "", 0, ""),
            ("old", "zz", "p", 9, 1, "", 0, ""),
            ("old", "ab", "p", 1, 2, "", 0, ""),
            ("nullts", "zz", "p", 1, None, "", 0, ""),
            ("nullts", "ab", "p", 1, 0, "", 0, ""),
            ("nulls", None, None, None, None, "", 0, ""),
            ("null2", None, "p", 5, None, "", 0, ""),
            ("only_a", "x", "p", 1, 1, "", 0, ""),
            ("case", "x", "P", 1, 1, "", 0, ""),
            (None, "x", "p", 1, 1, "", 0, ""),
        ],
        SUMS,
    )
    b = spark.createDataFrame(
        [
            ("same", "ab", "x/y/z", 1, 7, "", 1, ""),
            ("old", "AB", "p", 1, 1, "", 1, ""),
            ("nullts", "ab", "p", 1, 1, "", 1, ""),
            ("nulls", None, None, None, 3, "", 1, ""),
            ("null2", "a", "p", None, 3, "", 1, ""),
            ("only_b", None, None, None, None, "", 1, ""),
            ("case", "X", "p", 2, 1, "", 1, ""),
        ],
        SUMS,
    )
    assert compare(a, b) == [
        ("case", "path"), ("case", "size"), ("null2", "sha"), ("null2", "size"), ("only_a", "missing_in_copy"), ("only_b", "missing_in_baseline"),
    ]
    empty = a.limit(0)
    assert compare(empty, empty) == []
    assert {d for _, d in compare(empty, b)} == {"missing_in_baseline"}


def brute_periods(iv):
    out, byk = set(), {}
    for k, s, e in iv:
        if s is None or e is None or s != s or e != e or abs(s) == float("inf") or abs(e) == float("inf"):
            continue
        s, e = round(s * 1000), round(e * 1000)
        if e > s:
            byk.setdefault(k, []).append((s, e))
    for k, v in byk.items():
        merged = []
        for s, e in sorted(v):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out |= {(k, "period", s, e) for s, e in merged}
        out |= {(k, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:])}
    return sorted(out, key=repr)


def test_intervals_against_brute_force(spark):
    rnd = random.Random(4)
    iv = [(rnd.choice(["a", "b", None]), s := float(rnd.randint(0, 4000)) + rnd.choice([0, 1e-9, -1e-9]), s + rnd.choice([-3, 0, 1, 5, 5, 40, 900])) for _ in range(400)]
    iv += [("a", None, 1.0), ("b", float("nan"), 1.0), ("b", 2.0, float("inf")), ("c", 1.0, 1.0), ("neg", -7.5, -2.25), ("neg", -2.25, 3.0), ("far", 0.0, 9e5), *[("rep", 1.0, 2.0)] * 5]
    df = spark.createDataFrame([(*x, 1, 2, 3) for x in iv], "audio_id string, start double, end double, t int, b int, k int")
    for width in (intervals.BUCKET_MS, 700, 10**9):
        got = intervals.periods_and_gaps(df, "audio_id", intervals.to_ms(F.col("start")), intervals.to_ms(F.col("end")), width)
        assert rows(got) == brute_periods(iv)
    assert rows(intervals.periods_and_gaps(df.limit(0), "audio_id", intervals.to_ms(F.col("start")), intervals.to_ms(F.col("end")))) == []


def test_events_are_summed_before_they_are_shuffled(spark):
    df = spark.createDataFrame([("a", 0, 5000)] * 50, "audio_id string, s bigint, e bigint")
    got = intervals.periods_and_gaps(df, "audio_id", F.col("s"), F.col("e"))
    assert rows(got) == [("a", "period", 0, 5000)]
    plan = intervals.periods_and_gaps(df, "audio_id", F.col("s"), F.col("e"))._jdf.queryExecution().executedPlan().toString().split("\n")
    for at in [i for i, line in enumerate(plan) if "Generate explode" in line]:
        up = next(i for i in range(at, -1, -1) if "Exchange" in plan[i])
        assert any("partial_sum" in line for line in plan[up:at])


def split(g, *texts):
    return packed.split_packed(pa.array(list(texts), pa.string()), g).to_pylist()


def test_packed_tags():
    got = split(
        packed.TAGS, '"genre---7"" single cut" genre---glitch-hop "mood---late night"', None, "", " ;| \n", "genre---rock, instrumental\tgenre---folk ; 'mood---a''b'",
        "genre---children's  genre---late night", '"genre---open, mood---x', "[genre---a,mood---b]", "genre---drum & bass",
    )
    assert got == [
        ['genre---7" single cut', "genre---glitch-hop", "mood---late night"], [], [], [], ["genre---rock, instrumental", "genre---folk", "mood---a'b"],
        ["genre---children's", "genre---late night"], ["genre---open, mood---x"], ["genre---a", "mood---b"], ["genre---drum & bass"],
    ]


def test_packed_numbers():
    assert split(packed.LANGS, "['en:0.793', \"fr:0.097\"]", "en:0.9 ; ;ru:0.05\nyue:1", "en:0.5 fr:0.3", "[]") == [["en:0.793", "fr:0.097"], ["en:0.9", "ru:0.05", "yue:1"], ["en:0.5 fr:0.3"], []]
    assert split(packed.EVENTS, '"""Radio"" voice:25"; Choir:13|Strings, bowed, plucked:7; ', '"a:1"""', "Water; dripping:8,7\" vinyl:3", "é, ü:3,ß:4") == [
        ['"Radio" voice:25', "Choir:13", "Strings, bowed, plucked:7"], ['a:1"'], ["Water; dripping:8", '7" vinyl:3'], ["é, ü:3", "ß:4"],
    ]


NAMES = st.sampled_from(["Bell, handheld", "Water; dripping", '7" vinyl', "Radio's", "a b", "naïve", '"Hi" there', "x|y", "日本"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(NAMES, st.integers(0, 999), st.booleans(), st.sampled_from([",", "; ", " | ", "\t", "\n", ", ,", ";;"])), max_size=6), max_size=8))
def test_packed_round_trip(lists):
    """What is packed comes back, whatever the quoting and the delimiters."""
    packed_rows, want = [], []
    for items in lists:
        s = ""
        for name, n, q, d in items:
            v = f"{name}:{n}"
            s += ('"' + v.replace('"', '""') + '"' if q or v[0] in "\"'" else v) + d
        packed_rows.append(s)
        want.append([f"{a}:{b}" for a, b, _, _ in items])
    assert packed.split_packed(pa.array(packed_rows, pa.string()), packed.EVENTS).to_pylist() == want


def test_unpack_rows(spark):
    long = ";".join(f"n{i}:{i}" for i in range(20_000))
    df = spark.createDataFrame([("a", "x:1;y:2", 9), ("a", "x:1;y:2", 9), (None, "z:3", 9), ("b", None, 9), ("c", long, 9)], "item string, packed string, pos int")
    got = rows(packed.unpack(df, F.col("item"), F.col("packed"), packed.EVENTS))
    assert got[-1] == ("c", 9999, "n9998:9998") or len(got) == 20_005
    assert [r for r in got if r[0] != "c"] == [("a", 1, "x:1"), ("a", 1, "x:1"), ("a", 2, "y:2"), ("a", 2, "y:2"), (None, 1, "z:3")]
    assert rows(packed.unpack(df.limit(0), F.col("item"), F.col("packed"), packed.EVENTS)) == []
