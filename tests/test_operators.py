"""Core operators on small tables with known results."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import paths, text, vectors, vocabulary
from millrace.operators import annotations, chunks, dedup, density, frames, gates, packed, ranking, reports, similarity, splits, tables, tags
from millrace.operators.graph import connected_components
from millrace.plans import core_queries
from tests.conftest import rows


def test_components_against_brute_force(spark):
    rnd = random.Random(2)
    ids = rnd.sample(range(10_000), 260)
    edges = [(a, b) for a, b in zip(ids[:120], ids[1:120])] + [(rnd.choice(ids[120:]), rnd.choice(ids[120:])) for _ in range(90)] + [(ids[0], x) for x in ids[200:230]]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            lo, hi = sorted((find(a), find(b)))
            parent[hi] = lo
    df = spark.createDataFrame([*edges, *edges[:5], (7, 7), (None, 3)], "u bigint, v bigint")
    assert rows(connected_components(df, "u", "v")) == sorted(((x, find(x)) for x in parent), key=repr)
    assert rows(connected_components(df.limit(0), "u", "v")) == []


PII_TEXT = (
    "call 13812345678 or 010-12345678, id 11010519491231002X, card 6222021234567890123, mail a.b@c.org, "
    "host 192.168.1.254, see https://x.org/p?q=1 mac 00:1A:2b:3C:4d:5E at 88号楼 and 100000000000000000"
)


def test_pii(spark):
    df = spark.createDataFrame([(1, PII_TEXT), (2, None), (3, ""), (4, "nothing"), (5, "$1 13812345678")], "i int, text string")
    out, kinds = text.redact(df, "text")
    n = {k: F.col(f"n_{k}") for k in kinds}
    got = {r["i"]: r for r in out.select("i", "text", text.total(n).alias("n"), text.type_list(n).alias("t")).collect()}
    assert got[1]["t"] == "phone:1; id_card:2; email:1; bank_card:1; landline:1; ip_address:1; url:1; mac_address:1; chinese_address:1" and got[1]["n"] == 10
    assert got[1]["text"].count("[REDACTED]") == 10
    assert (got[2]["text"], got[2]["n"], got[3]["text"], got[4]["text"]) == (None, 0, "", "nothing")
    assert got[5]["text"] == "$1 [REDACTED]"
    again, _ = text.redact(out.select("i", "text"), "text")
    assert {r["text"] for r in again.collect()} == {r["text"] for r in got.values()}


def test_names(spark):
    df = spark.createDataFrame([("王小明, 李先生, 王子",)], "t string")
    r = df.select(text.chinese_names(F.col("t"), "王李").alias("n"), text.redact_names(F.col("t"), "王李", "X").alias("c")).first()
    assert r["n"] == ["王小明", "李先生"] and r["c"] == "X, X, 王子"


def test_safety(spark):
    df = spark.createDataFrame([("暴力 暴力 血腥",), ("13812345678",), (None,), ("毒品 吸毒 海洛因 赌博 赌场",)], "t string")
    s, n, level, safe = text.safety(F.col("t"))
    got = [tuple(r) for r in df.select(F.round(s, 4), n, level, safe).collect()]
    assert got == [(0.32, 2, "medium", True), (0.045, 1, "low", True), (0.0, 0, "safe", True), (0.78, 5, "high", False)]


def test_tags(spark):
    assert vocabulary.INDEXES["mood"]["relaxed"] == "relaxing" and vocabulary.INDEXES["instrument"]["bassguitar"] == "electric bass"
    df = spark.createDataFrame([("e piano",), ("Rhodes",), ("GTR",), ("unknown instrument",), ("",), ("-",), (None,), ("my rhodes solo",), ("Rhodes",)], "tag string")
    got = [(r["tag"], r["standard"], r["matched"]) for r in tags.standardise(df, "tag", "instrument").collect()]
    assert sorted(got, key=repr) == sorted(
        [("e piano", "electric piano", True), ("Rhodes", "electric piano", True), ("Rhodes", "electric piano", True), ("GTR", "guitar", True), ("unknown instrument", None, False),
         ("", None, False), ("-", None, False), (None, None, False), ("my rhodes solo", "electric piano", True)], key=repr
    )
    m = spark.createDataFrame([(["Piano ", "bass", "electric bass", "happy", "R&B", "low quality", "kazoo"],), (None,)], "t array<string>").select(tags.map_tags(F.col("t")).alias("m")).select("m.*").collect()
    assert tuple(m[0]) == ([0, 34], ["happy"], ["r&b"], ["kazoo"]) and tuple(m[1]) == ([], [], [], [])
    lab = spark.range(1).select(tags.program_texts(F.array(F.lit(0), F.lit(5), F.lit(24))).alias("t")).first()["t"]
    assert lab == "0:piano, unknown_gm(5), 24:acoustic guitar"
    lst = spark.createDataFrame([("['a', \"b's\"]",), ("oops",), (None,)], "t string").select(text.python_list(F.col("t")).alias("l")).collect()
    assert [r["l"] for r in lst] == [["a", "b's"], [], []]


def test_gates(spark):
    df = spark.createDataFrame(
        [("wav", 30.0, 10, 44100, 2), ("MP3", 30.0, 10, 22050, 1), ("exe", 0.1, 10, 1, 1), (None, 1.0, 1, 1, 1), ("wav", 0.5, 10, 1, 1), ("wav", 601.0, 10, 1, 1), ("wav", None, 3 * 10**8, None, None)],
        "f string, d double, b bigint, r int, c int",
    )
    got = [(r["reason"], r["tags"]) for r in gates.ingest_check(df, *(F.col(c) for c in "fdbrc")).collect()]
    assert got == [(None, []), (None, ["low_sample_rate:22050", "mono_audio", "lossy_format"]), ("unsupported_format: exe", []), ("unsupported_format: ", []), ("too_short", []), ("too_long", []), ("too_large", [])]
    good, bad = gates.routed(gates.ingest_check(df, *(F.col(c) for c in "fdbrc")))
    assert (good.count(), bad.count()) == (2, 5)
    q = spark.createDataFrame([(30.0, 44100, 0.1, 0.0, float("inf")), (2.0, 44100, 0.995, 0.06, 12.0), (float("nan"), 0, 0.8, None, float("-inf"))], "d double, r int, s double, c double, n double")
    q = gates.quality_gate(q, {"duration": F.col("d"), "sample_rate": F.col("r"), "silence_ratio": F.col("s"), "clipping_ratio": F.col("c"), "snr_db": F.col("n")})
    assert [(r["passed"], r["reasons"], r["warnings"]) for r in q.collect()] == [(True, [], []), (False, ["too_short", "silent", "clipping"], ["low_snr"]), (True, [], ["high_silence", "low_snr"])]
    flags = spark.createDataFrame([(1, None, float("nan")), (1, "x", 1.0)], "a int, b string, c double")
    assert [r[0] for r in flags.select(gates.missing_flags(flags)).collect()] == ["missing_b;missing_c;", ""]
    bits = spark.createDataFrame([("PCM_16",), ("MPEG_LAYER_III",), ("FLOAT",), (None,)], "b string").select(gates.bit_depth(F.col("b"))).collect()
    assert [r[0] for r in bits] == [16, 0, 32, 0]


def test_paths(spark):
    df = spark.createDataFrame([("a/b/x.y_01KX.tar.wav", "01jwr834ppe0xaap1cwm0v7gyc"), ("noid.wav", "bad")], "p string, i string")
    got = [tuple(r) for r in df.select(paths.stem(F.col("p")), paths.id_in_name(F.col("p")), paths.valid_id(F.col("i"))).collect()]
    assert got == [("x.y_01KX.tar", "01KX.TAR", True), ("noid", None, False)]


def test_exact_duplicates(spark):
    df = spark.createDataFrame([("h", "b", 5), ("h", "a", 5), ("h", "c", 9), ("h", "c", 9), ("u", "d", 1), (None, "e", 1), (None, "f", 1), ("h", None, 99)], "sha string, id string, n bigint")
    assert rows(dedup.exact_groups(df, "sha", "id", "n")) == [("h", "c", 3)]
    assert rows(dedup.exact_links(df, "sha", "id", "n")) == [("a", "c"), ("b", "c")]
    assert rows(dedup.keep_first(df, "sha", [F.coalesce("id", F.lit("~")), F.col("n")]).select("id")) == [("a",), ("d",), ("e",), ("f",)]
    assert rows(dedup.exact_groups(df.limit(0), "sha", "id", "n")) == []


def points(seed, n, dim=6):
    rnd = np.random.default_rng(seed)
    c = rnd.normal(size=(6, dim))
    x = c[rnd.integers(0, 6, n)] + rnd.normal(0, 0.35, (n, dim))
    return [(i, [float(v) for v in x[i]], "ab"[i % 2]) for i in range(n)]


@pytest.mark.parametrize("block", [2048, 7])
def test_similar_pairs_against_brute_force(spark, block):
    data = points(1, 150)
    x = np.array([v for _, v, _ in data])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = u @ u.T
    df = spark.createDataFrame([*data, (900, None, "a"), (None, data[0][1], "a"), (901, [0.0] * 6, "a")], "id bigint, v array<double>, s string")
    for t in (0.5, 0.9, 0.97):
        want = {(i, j) for i in range(150) for j in range(i + 1, 150) if sim[i, j] >= t}
        assert {(r["id_1"], r["id_2"]) for r in similarity.similar_pairs(df, "id", "v", t, block=block).collect()} == want
        apart = {(r["id_1"], r["id_2"]) for r in similarity.similar_pairs(df, "id", "v", t, apart="s", block=block).collect()}
        assert apart == {(i, j) for i, j in want if i % 2 != j % 2}
    assert rows(similarity.similar_pairs(df.limit(0), "id", "v", 0.5)) == []


def test_far_blocks_are_not_compared(spark):
    """Clusters far from one another: most pairs of blocks hold no similar pair, and rows are shipped to few of them."""
    rnd = np.random.default_rng(2)
    c = np.eye(8)
    x = c[np.arange(400) % 8] + rnd.normal(0, 0.01, (400, 8))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(400)], "id bigint, v array<double>")
    got = similarity.similar_pairs(df, "id", "v", 0.95, block=50)
    assert got.count() == 8 * 50 * 49 // 2
    made = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(others" in made


def test_near_duplicate_policies(spark):
    pairs = spark.createDataFrame([(1, 2, 0.95), (1, 3, 0.95), (2, 4, 0.95), (3, 4, 0.92), (8, 9, 0.99)], "id_1 bigint, id_2 bigint, similarity double")
    items = spark.createDataFrame([(1, 1.0, 10), (2, 2.0, 5), (3, 1.0, 50), (4, 1.0, 1), (8, 1.0, 1), (9, 1.0, 1)], "id bigint, q double, n bigint")
    # 1 loses to 2 and still goes on to beat 3; 2 beats 4
    assert [r[:2] for r in rows(dedup.greedy(pairs, items, "id", ["q"]))] == [(1, 2), (3, 1), (4, 2), (9, 8)]
    got = rows(dedup.stars(pairs, items, "id", "n"))
    assert [r[:3] for r in got] == [(1, 1, 3), (1, 2, 3), (1, 3, 3), (8, 8, 8), (8, 9, 8)] and got[1][3] is None


def test_dbscan_against_brute_force(spark):
    data = points(4, 160)
    x = np.array([v for _, v, _ in data])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = 1 - u @ u.T <= 0.05
    core = near.sum(1) >= 5
    label = np.full(160, -1)
    for i in range(160):
        if core[i] and label[i] < 0:
            todo, label[i] = [i], i
            while todo:
                p = todo.pop()
                for q in np.flatnonzero(near[p] & core & (label < 0)):
                    label[q] = i
                    todo.append(q)
    for i in np.flatnonzero(~core):
        c = label[near[i] & core]
        label[i] = c.min() if len(c) else -1
    number = {v: k for k, v in enumerate(sorted(set(label) - {-1}))}
    df = spark.createDataFrame(data, "id bigint, v array<double>, s string")
    got = dict(rows(density.dbscan(df, "id", "v", 0.05, 5)))
    assert got == {i: number.get(label[i], -1) for i in range(160)}


def test_frames(spark):
    df = spark.createDataFrame([("a", 0, "Music", 0.9), ("a", 1, "Speech", 0.1), ("a", 2, "Silence", 0.5), ("b", 0, "Music", 0.1), ("b", 1, "Rain", None), ("b", 2, None, 0.0)], "t string, i int, n string, c double")
    got = {r["t"]: r for r in frames.frame_to_item(df, "t", "n", F.col("c")).collect()}
    assert (got["a"]["music_ratio"], got["a"]["has_speech"], got["a"]["has_silence"], got["a"]["high_confidence_frames"]) == (0.5, False, True, 2)
    assert (got["b"]["high_confidence_frames"], got["b"]["noise_ratio"]) == (3, 1 / 3)
    assert rows(frames.top_tags(df, "t", "n", "i", 2)) == [("a", "Music:1; Speech:1"), ("b", "Music:1; Rain:1")]
    beats = spark.createDataFrame([("a", t) for t in (1.0, 2.0, 4.0, 100000.0)] + [("b", 5.0), ("c", None)], "t string, s double")
    got = {r["t"]: r for r in frames.interval_stats(beats, "t", F.col("s")).collect()}
    assert (got["a"]["n"], got["a"]["min"], got["a"]["max"]) == (4, 1.0, 99996.0) and got["b"]["mean"] is None and "c" not in got
    v = spark.createDataFrame([("a", 1, [1.0, 2.0]), ("a", 1, [3.0, 4.0]), ("a", 2, [10.0, 10.0])], "g string, c int, v array<double>")
    assert rows(frames.mean_pool(v, ["g"], "v", "c")) == [("a", (6.0, 6.5))]


def test_chunks(spark):
    df = spark.createDataFrame([("a", 30.0), ("b", 4.9), ("c", 5.0), ("d", 32.0), ("e", None), ("f", float("nan")), ("g", 0.0)], "id string, d double")
    got = rows(chunks.sliding_chunks(df, "id", F.col("d"), 10, 0.5, 5))
    assert [r[3:] for r in got if r[1] == "a"] == [(0.0, 10.0, 10.0), (5.0, 15.0, 10.0), (10.0, 20.0, 10.0), (15.0, 25.0, 10.0), (20.0, 30.0, 10.0), (25.0, 30.0, 5.0)]
    assert {r[1] for r in got} == {"a", "c", "d"} and got[0][0] == "a_chunk0000"
    assert [r[1:] for r in rows(chunks.blocks(df, "id", F.col("d"))) if r[0] == "d"] == [(0, 0.0, 30.0), (1, 30.0, 32.0)]
    with pytest.raises(ValueError):
        chunks.sliding_chunks(df, "id", F.col("d"), overlap=1.0)


@pytest.mark.parametrize("n", [0, 1, 2, 97])
def test_splits_partition_the_rows(spark, n):
    df = spark.createDataFrame([(i, "xyz"[i % 3] if i % 7 else None, i // 4) for i in range(n)], "id bigint, s string, g int")
    whole = list(range(n))
    for got in (splits.random_split(df, "id"), splits.temporal_split(df, "g", "id"), splits.stratified_split(df, "s", "id"), splits.holdout_first_split(df, "id")):
        assert sorted(r["id"] for r in got.collect()) == whole
        assert {r["split"] for r in got.collect()} <= {"train", "val", "test", "holdout_gold"}
    iso = splits.isolated_split(df, "g").collect()
    assert len({(r["g"], r["split"]) for r in iso}) == len({r["g"] for r in iso})
    if n == 2:  # ratios sum to 1.01 and are scaled; what floor() leaves is the holdout
        assert sorted(r["split"] for r in splits.random_split(df, "id").collect()) == ["holdout_gold", "train"]


def test_split_checks(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "train"), ("b", "train"), ("b", "test"), ("c", "val"), (None, "val")], "id string, split string")
    assert rows(splits.leaked(df, "id")) == [("b", ("test", "train"))]
    assert rows(splits.overlaps(df, "id")) == [("test", "train", 1)]
    known = spark.createDataFrame([("a",), ("b",)], "id string")
    got = {r["check"]: r["failures"] for r in splits.verify(df, known, known.limit(1), "id", ["train", "val", "test", "holdout_gold"]).collect()}
    assert got == {"completeness": 2, "leakage": 1, "existence": 1, "checksum": 2, "overall": 6}


def test_global_rank(spark):
    df = spark.createDataFrame([(i * 7919 % 1000,) for i in range(1000)], "x bigint")
    got = ranking.global_rank(df.repartition(5), [F.col("x")]).collect()
    assert all(r["rank"] == r["x"] + 1 for r in got)


def test_tables(spark):
    a = spark.createDataFrame([("x", 1, "h"), ("y", 2, "h"), ("z", None, "h"), ("s", 1, "h")], "p string, n bigint, c string")
    b = spark.createDataFrame([("x", 1, "h"), ("y", 3, "h"), ("z", None, "g"), ("w", 1, "h")], "p string, n bigint, c string")
    assert rows(tables.inventory_diff(a, b, "p", "n", "c")) == [("s", "missing"), ("w", "extra"), ("x", "ok"), ("y", "size_mismatch"), ("z", "checksum_mismatch")]
    assert rows(tables.upsert_last([a, b], "p").select("p", "c")) == [("s", "h"), ("w", "h"), ("x", "h"), ("y", "h"), ("z", "g")]
    assert rows(tables.append_new(a, b, "p").select("p")) == [("s",), ("w",), ("x",), ("y",), ("z",)]
    assert rows(tables.patch(a, b.select("p", "n"), "p", ["n"]).select("p", "n")) == [("s", 1), ("x", 1), ("y", 3), ("z", None)]
    assert tuple(tables.hit_rate(a, b, "p", "p").first()) == (4, 3, 75.0) and tuple(tables.hit_rate(a.limit(0), b, "p", "p").first()) == (0, 0, 0.0)
    assert rows(tables.unmatched(a, b, "p", "p")) == [("s",)]


def test_reports(spark):
    df = spark.createDataFrame([(0.0, "a"), (10.0, "a"), (float("nan"), "b"), (-1.0, None), (None, "b"), (5.0, "b")], "x double, s string")
    assert rows(reports.histogram(df, "x", 0, 10, 5)) == [(0, 1), (1, 1), (3, 1), (5, 1)]
    assert rows(reports.value_counts(df, "s")) == [("a", 2), ("b", 3)]
    f = rows(reports.funnel([("all", df), ("some", df.where("s = 'a'"))]))
    assert f == [(0, "all", 6, 100.0), (1, "some", 2, 33.33)]


def test_vectors(spark):
    r = spark.range(1).select(
        vectors.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))), vectors.argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))),
        vectors.decibels(F.lit(100.0), F.lit(1.0)), vectors.decibels(F.lit(1.0), F.lit(0.0)), vectors.peak_gain(F.lit(6.0), 0.0), vectors.unit(F.array(F.lit(0.0))),
    ).first()
    assert abs(r[0] - 0.5**0.5) < 1e-12 and r[1] == 1 and r[2] == 20.0 and r[3] == float("inf") and abs(r[4] - 10**-0.3) < 1e-12 and r[5] == [0.0]


def test_grades(spark):
    df = spark.createDataFrame([(0.5, False, None, None), (0.7, False, None, None), (0.9, None, None, None), (0.9, True, True, None), (0.9, False, None, None)], "d double, m boolean, s boolean, n boolean")
    got = [tuple(r) for r in df.select(*density.grade(*(F.col(c) for c in "dmsn"))).collect()]
    assert got == [("substyle_variant", "keep", False), ("substyle_outlier", "keep", True), ("extreme_style_variant", "keep", True), ("non_music_outlier", "reject", True), ("non_music_outlier", "reject", True)]


def test_annotations(spark):
    line = '{"id": "1", "data": {"audio": "p"}, "annotations": [{"result": [{"from_name": "mood", "value": {"choices": ["calm", "sad"]}}, {"from_name": "note", "value": {"text": ["hi"]}}]}]}'
    df = spark.createDataFrame([(line,), ('{"id": "2"}',)], "value string").select(F.from_json("value", annotations.ANNOTATION).alias("r")).select("r.*")
    got = [tuple(r)[:4] for r in annotations.flatten(df, ["mood"], ["note"]).collect()]
    assert got == [("1", "p", "calm", "hi"), ("2", None, "", "")]


def test_packed_feeds_tags(spark):
    df = spark.createDataFrame([("t", "instrument---e-piano; instrument---drums")], "k string, v string")
    items = packed.unpack(df, F.col("k"), F.col("v"), packed.TAGS).select(F.substring_index("item", "---", -1).alias("tag"))
    assert {r["standard"] for r in tags.standardise(items, "tag", "instrument").collect()} == {"electric piano", "drums"}


def test_nearest_of_more_than_a_thousand_centroids(spark, tmp_path):
    df = spark.range(1002).selectExpr("id AS vec_id", "CAST(id AS int) AS label", "array(CAST(id AS float)) AS embedding")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = core_queries.outlier_grades(spark, str(tmp_path))
    assert rows(got.select("vec_id", "nearest", "distance")) == sorted([(i, i, 0.0) for i in range(1002)], key=repr)
