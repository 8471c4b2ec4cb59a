"""Gates, reports, retention, ingest, signals and configuration on small tables with known results."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import runtime
from millrace.functions import vocabulary
from millrace.operators import dedup, density, gates, ingest, reports, retention, signal, splits, tables, tags
from millrace.plans.bundles import dedup_stages, output_path, write_bundle
from millrace.plans.pipeline import Pipeline
from millrace.sources import config, files
from millrace.streaming import windows
from tests.conftest import rows


def test_content_and_vocal_gates(spark):
    df = spark.createDataFrame([(True, True, 0.1, True), (False, True, 0.1, True), (None, None, None, None), (True, True, 0.9, True), (True, True, float("nan"), False)], "m boolean, i boolean, v double, s boolean")
    ok, why = gates.content_gate(*(F.col(c) for c in "mivs"), instrumental_only=True, max_vocal_ratio=0.5)
    assert [tuple(r) for r in df.select(ok, why).collect()] == [(True, None), (False, "not_music"), (False, "not_instrumental"), (False, "too_vocal"), (False, "unsafe")]
    v = spark.createDataFrame([(0.9, None), (0.1, None), (0.5, 0.2), (0.5, 0.05), (None, 0.05), (float("nan"), None), (0.7, None), (0.3, None)], "r double, e double")
    got = [tuple(r) for r in v.select(*gates.vocal_gate(F.col("r"), F.col("e"), "check")).collect()]
    assert got == [("vocals", True), ("no_vocals", False), ("unsure", True), ("unsure", False), ("estimated", False), ("estimated", True), ("unsure", True), ("unsure", True)]
    assert [r[0] for r in v.select(gates.vocal_gate(F.col("r"), F.col("e"), "skip")[1]).collect()][2:4] == [False, False]
    with pytest.raises(ValueError):
        gates.vocal_gate(F.col("r"), F.col("e"), "else")
    t = spark.createDataFrame([("zh", True), ("en", True), ("fr", True), ("en", None), (None, True)], "l string, s boolean")
    got = [tuple(r) for r in t.select(*gates.transcription_route(F.col("l"), F.col("s"), ["zh"], ["zh", "en"], second_tool=False)).collect()]
    assert got == [("ready", "first"), ("no_tool", None), ("skipped_language", None), ("no_vocals", None), ("skipped_language", None)]
    assert [r[0] for r in spark.createDataFrame([(3.9,), (0.0,), (None,), (float("nan"),)], "d double").select(gates.segment_end(F.col("d"))).collect()] == [3, 10, 10, 10]
    assert gates.required(df, ["absent"]).count() == 5 and gates.required(df, ["m", "v"]).count() == 3  # NaN is no value


def test_reports_over_several_columns(spark):
    df = spark.createDataFrame([("暴力 毒品 吸毒 海洛因", None, 1), ("x", "13812345678", 2), (None, None, 3)], "a string, b string, max_risk int")
    got = [(r["unsafe_columns"], r["matches"], r["risk_level"], r["is_safe"]) for r in reports.risk_report(df.drop("max_risk"), ["a", "b", "none"]).collect()]
    assert got == [("a", 4, "high", False), ("", 1, "low", True), ("", 0, "safe", True)]
    red = [(r["a_removed"], r["total_removed"], r["all_types"]) for r in reports.redaction_report(df, ["a", "b"], ("phone",)).collect()]
    assert red == [(0, 0, ""), (0, 1, "phone:1"), (0, 0, "")]
    n = spark.createDataFrame([(0.125, ["x", "y", "z"]), (float("inf"), None), (None, []), (float("nan"), ["q"])], "v double, l array<string>")
    got = [tuple(r) for r in reports.serialised(n, {"v": 2}, {"l": 2}).collect()]
    assert got[0] == (0.12, "x; y") and got[1] == (float("inf"), None) and got[2] == (None, "") and math.isnan(got[3][0])
    assert tuple(reports.tallies(spark.createDataFrame([("ok",), ("bad",), (None,), ("?",)], "s string"), F.col("s"), ["ok"], ["bad"]).first()) == (4, 1, 1, 2)
    assert n.select(reports.joined(F.col("l"), " | ", 2)).first()[0] == "x | y"


def test_retention(spark):
    df = spark.createDataFrame([("a", i, i % 2 == 0 if i else None) for i in range(4)] + [("b", 9, False)], "g string, t int, ok boolean")
    got = {(r["g"], r["t"]): r["action"] for r in retention.rotate(df, ["g"], [F.desc("t")], 2, F.col("ok")).collect()}
    assert got == {("a", 3): "keep", ("a", 2): "keep", ("a", 1): "skip", ("a", 0): "skip", ("b", 9): "keep"}
    ages = spark.createDataFrame([("c", 8, True), ("c", 7, True), ("c", 8, None), ("log", 91, False), ("x", 999, True), ("c", None, True)], "k string, n int, ok boolean")
    assert [r[0] for r in ages.select(retention.expire(F.col("k"), F.col("n"), {"c": 7, "log": 90}, F.col("ok"), ["log"])).collect()] == ["delete", "keep", "skip", "delete", "keep", "keep"]
    t = spark.createDataFrame([(dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)), (dt.datetime(2025, 1, 1, 1), dt.datetime(2025, 1, 2))], "a timestamp, b timestamp")
    assert [r[0] for r in t.select(retention.age_in_days(F.col("a"), F.col("b"))).collect()] == [1, 0]
    assert [r[0] for r in spark.createDataFrame([(90,), (80,), (79,), (None,)], "u int").select(retention.disk_level(F.col("u"), F.lit(100))[1]).collect()] == ["critical", "warning", "normal", None]
    f = spark.createDataFrame([("p", True, 5, 5), ("p", True, 5, 4), ("q", True, 1, 1), ("r", None, 1, 1)], "g string, s boolean, a int, b int")
    assert rows(retention.transfer_verdict(f, "g", F.col("s"), F.col("a"), F.col("b"))) == [("p", 2, 0, 1, False), ("q", 1, 0, 1, True), ("r", 1, 1, 0, False)]
    a, b = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", None)], "k string, c string"), spark.createDataFrame([("x", "1"), ("z", None)], "k string, c string")
    s = retention.integrity(a, b, "k", "c")
    assert rows(s) == [("x", "verified"), ("y", "missing"), ("z", "corrupted")] and rows(retention.to_restore(s, b, "k")) == [("y", "lost"), ("z", "backup")]
    texts = spark.createDataFrame([("l", '{"a":1}\n\n{"b":2}\r\n'), ("j", '[{"a":1},{"b":2},3]'), ("e", ""), ("n", None)], "p string, t string")
    assert {r["p"]: r["annotations"] for r in retention.annotation_counts(texts, "p", "t").collect()} == {"l": 2, "j": 3, "e": 0, "n": 0}


def test_ingest(spark):
    u = spark.createDataFrame([(0, "a"), (1469918176385, "a"), (1469918176385, "b"), (None, "a"), (-1, "a")], "t bigint, s string").select(ingest.ulid(F.col("t"), F.col("s"))).collect()
    assert u[0][0].startswith("0000000000") and u[1][0].startswith("01ARYZ6S41") and len(u[1][0]) == 26 and u[1] != u[2] and u[3][0] is None and u[4][0] is None
    f = spark.createDataFrame([("d/x_01JWR834PPE0XAAP1CWM0V7GYC.wav", 5, "h"), ("noid.wav", 1, "h")], "p string, n bigint, c string")
    sums, manifest = ingest.records(f, "p", "n", "c", F.lit(None).cast("timestamp"))
    assert sums.count() == 1 and manifest.first()["format"] == "wav"
    items = spark.createDataFrame([("a", "p", None), ("b", " ", 1.0), (None, "p", 1.0), ("c", "q", float("nan"))], "id string, p string, d double")
    got = ingest.manifest_items(items, "id", "p", "d")
    assert rows(got) == [("a", "p", 0.0), ("c", "q", 0.0)] and rows(ingest.items_or_folder(got.limit(0), items.where("id = 'b'"), ["id"])) == [("b",)]
    there, gone = ingest.batch(spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "id string"), items, "id")
    assert rows(there.select("id")) == [("a",)] and rows(gone) == [("z",)]
    assert ingest.wave_header(b"RIFF....WAVEfmt ") == (None,) * 4 and ingest.wave_header(None) == (None,) * 4


def test_signals(spark):
    rate = 8000
    tone = [math.sin(2 * math.pi * 440 * i / rate) for i in range(8192)]
    df = spark.createDataFrame([(1, tone, rate), (2, None, rate), (3, [], rate), (4, [0.5], rate), (5, [0.0] * 100, rate)], "i int, x array<double>, r int")
    got = {r["i"]: r for r in signal.spectral_features(df, "i", "x", "r").collect()}
    assert abs(got[1]["spectral_centroid_mean"] - 440) < 20 and got[1]["vocal_band_ratio"] > 0.99 and int(np.argmax(got[1]["chroma"])) == signal.NOTES.index("A")
    assert got[2]["chroma"] is None and got[3]["spectral_flux"] is None and got[4]["spectral_flux"] == 0.0
    q = {r["i"]: r for r in df.select("i", *[c.alias(n) for n, c in signal.quality(F.col("x")).items()]).collect()}
    assert q[1]["silence_ratio"] == 0.0 and q[1]["snr_db"] == float("inf") and abs(q[1]["dynamic_range_db"]) < 0.1
    assert q[5]["silence_ratio"] == 1.0 and q[5]["dynamic_range_db"] == 0.0 and q[2]["silence_ratio"] is None
    d = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0],), ([],), (None,)], "x array<double>").select(signal.delta(F.col("x")).alias("d")).collect()
    assert abs(d[0]["d"][5] - 1.0) < 1e-12 and d[1]["d"] is None and d[2]["d"] is None
    assert spark.range(1).select(signal.stem_share(F.array(F.lit(3.0)), F.array(F.lit(4.0)))).first()[0] == 9 / 25
    two = spark.range(1).select(gates.vocal_ratio(F.lit(0.5), F.lit(100.0)), gates.vocal_ratio(F.lit(2.0), harmonic=F.lit(1.0))).first()
    assert abs(two[0] - 0.5) < 1e-12 and two[1] == 1.0


def test_label_check_and_projection(spark):
    e = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [0.0, 1.0]), (3, "b", [1.0, 1.0]), (4, "a", None), (5, "a", [0.0, 0.0])], "id int, l string, v array<double>")
    ref = spark.createDataFrame([("a", [1.0, 0.0])], "name string, v array<double>")
    assert {r["id"]: r["verdict"] for r in density.label_check(e, "id", "l", ref, "name", "v").collect()} == {1: "match", 2: "mismatch", 3: "not_found", 4: "not_found", 5: "error"}
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(200, 5)) * np.array([5, 2, 1, 0.5, 0.1])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, v array<double>")
    p = np.array([r["point"] for r in density.projection(df, "id", "v").orderBy("id").collect()])
    want = np.linalg.eigvalsh(np.cov(x.T))[::-1][:2]
    assert np.allclose(p.var(0, ddof=1), want) and np.allclose(p.mean(0), 0, atol=1e-9)
    assert density.projection(df.limit(0), "id", "v").count() == 0
    far = spark.createDataFrame([(i, [float(i % 2) * 100, float(i)]) for i in range(20)], "id int, v array<double>")
    got = {r["id"]: r["cluster"] for r in density.k_means(far, "id", "v", 2).collect()}
    assert len({got[i] for i in range(0, 20, 2)}) == 1 and got[0] != got[1]


def test_segments_of_items(spark):
    e = spark.createDataFrame([("a", 0, [1.0, 0.0]), ("a", 1, [1.0, 0.01]), ("b", 0, [1.0, 0.0]), ("b", 1, [0.0, 1.0]), (None, 0, [1.0, 0.0]), ("c", 0, [0.0, 1.0])], "item string, n int, v array<double>")
    p, n = dedup.segment_pairs(e, "item", "n", "v", 0.9)
    assert [r[:4] for r in rows(p)] == [("a", 0, "b", 0), ("a", 1, "b", 0), ("b", 1, "c", 0)] and rows(n) == [("a", "b", 2), ("b", "c", 1)]
    assert rows(dedup.segment_pairs(e.limit(0), "item", "n", "v", 0.9)[1]) == []


def test_isolation(spark):
    s = spark.createDataFrame([("a", "train"), ("b", "test"), ("c", "test"), ("d", "holdout_gold"), ("e", "val"), (None, "test")], "id string, split string")
    m = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "z"), ("e", None)], "id string, batch string")
    assert rows(splits.shared_batches(s, m, "id", "batch")) == [("test", "x")]
    assert rows(splits.isolation(s, m, "id", "batch")) == [("holdout_gold", 0, True), ("test", 1, False)]
    assert rows(splits.seen_before(s.union(spark.createDataFrame([("a", "test")], s.schema)), "id", ["train", "val", "test"])) == [("test", 3, 1), ("train", 1, 0), ("val", 1, 0)]
    with pytest.raises(ValueError):
        splits.require_apart(s.union(spark.createDataFrame([("a", "test")], s.schema)), "id")
    assert rows(splits.require_apart(s, "id")) == []
    assert rows(tables.inner(s.where("id = 'a'"), m.toDF("k", "batch"), "id", "k")) == [("a", "train", "a", "x")]


def test_dedup_in_stages(spark, tmp_path):
    df = spark.createDataFrame([("a", "h", 5, "train"), ("b", "h", 9, "train"), ("c", "i", 1, "train"), ("d", "j", 1, "test"), ("e", None, 1, "val")], "id string, hash string, size int, split string")
    pairs = {("b", "c"): 0.95, ("c", "d"): 0.9}
    found = lambda t: spark.createDataFrame([(*k, v) for k, v in pairs.items()], "id_1 string, id_2 string, similarity double").join(t.select(F.col("id").alias("id_1")), "id_1", "left_semi").join(t.select(F.col("id").alias("id_2")), "id_2", "left_semi")
    run = Pipeline(dedup_stages("id", "hash", "size", found, ["size"], "split")).run(df)
    assert rows(run.data.select("id")) == [("b",), ("d",), ("e",)]
    assert rows(run.rejects("id")) == [("exact", "a", "same_hash"), ("near", "c", "similar")]
    pairs[("b", "d")] = 0.9
    run = Pipeline(dedup_stages("id", "hash", "size", found, ["size"], "split")).run(df, only=["across"])
    assert rows(run.rejects("id")) == [("across", "b", "leaks"), ("across", "c", "leaks")]
    paths = write_bundle(run, "id", str(tmp_path), "v1")
    assert set(paths) == {"data", "counts", "rejects"} and spark.read.parquet(paths["rejects"]).count() == 2
    assert output_path("/r/", "v1", "quality") == "/r/v1/manifest" and output_path("/r", "v1", "split") == "/r/v1/split"


def test_configuration(tmp_path):
    (tmp_path / "p.toml").write_text('[quality]\nmin_duration = 7\nformats = ["wav"]\n[a.b]\nc = "x"\n')
    (tmp_path / ".env").write_text("# note\nTOKEN='t t'\nexport FLAG=yes\nbroken\n")
    (tmp_path / "g.json").write_text('{"a": {"b": {"d": 1}}, "TOKEN": "global"}')
    c = config.Config(config.read(tmp_path / "p.toml"), config.read(tmp_path / "g.json"), names=["HOMEX"], environment={"HOMEX": "h", "TOKEN": "env", "OTHER": "no"})
    assert c.get("a.b.c") == "x" and c.get("a.b.d", kind=float) == 1.0 and c.get("TOKEN") == "global" and c.get("HOMEX") == "h" and c.get("OTHER", "none") == "none"
    assert config.read(tmp_path / ".env") == {"TOKEN": "t t", "FLAG": "yes"} and config.read(tmp_path / "none.json") == {}
    assert config.Config({"f": "off"}).get("f", kind=bool) is False and c.ready(["TOKEN", "zz"]) == {"TOKEN": True, "zz": False}
    assert c.fill(gates.QualityRules, "quality").min_duration == 7 and c.fill(gates.QualityRules, "zz") == gates.QualityRules()


def test_dictionary_and_blacklist(spark):
    v = vocabulary.parse_dictionary('{"instrument_gm128_map": {"kalimba": 108}, "emotion_vad_map": {"calm": {"valence": 1, "arousal": 0, "dominance": 0.5}}, "genre_3level_map": {"R&B": ["x", "y"]}, "blacklist_tags": ["bad audio"]}')
    df = spark.createDataFrame([("Kalimba",), ("bad-audio",), ("",), (None,)], "t string")
    got = [(r["standard"], r["program"]) for r in tags.standardise(df, "t", "instrument", v).collect()]
    assert sorted(got, key=repr) == sorted([("kalimba", 108), (None, None), (None, None), (None, None)], key=repr)
    assert [r[0] for r in df.select(tags.blacklisted(F.col("t"), v)).collect()] == [False, True, False, False]
    g = tags.standardise(spark.createDataFrame([("r&b",)], "t string"), "t", "genre", v).first()
    assert (g["level1"], g["level2"], g["level3"]) == ("x", "y", None)
    none = vocabulary.parse_dictionary("{}")
    assert tags.standardise(df, "t", "mood", none).where("matched").count() == 0 and not df.select(tags.blacklisted(F.col("t"), none)).first()[0]
    s = spark.createDataFrame([({"en": 0.5, "de": 0.5, "fr": 0.1},), ({},), (None,)], "m map<string, double>").select(tags.most_likely(F.col("m"), 2).alias("t")).collect()
    assert [e["name"] for e in s[0]["t"]] == ["de", "en"] and s[1]["t"] == [] and s[2]["t"] is None


def test_input_lists_and_late_rows(spark):
    assert rows(files.input_list(spark.createDataFrame([("i", "/a/b.wav"), (None, "/c/d.wav")], "track_id string, path string"))) == [("d", "/c/d.wav"), ("i", "/a/b.wav")]
    assert rows(files.input_list(spark.createDataFrame([("/a/b.wav", "x")], "file string, other string"))) == [("b", "/a/b.wav")]
    t = lambda h: dt.datetime(2025, 1, 1, h)
    seen = spark.createDataFrame([(t(10),)], "t timestamp")
    fresh, late = windows.late_rows(spark.createDataFrame([(t(9),), (t(7),), (None,)], "t timestamp"), seen, "t", "2 HOURS")
    assert fresh.count() == 1 and late.count() == 2
    fresh, late = windows.late_rows(seen, seen.limit(0), "t", "2 HOURS")
    assert fresh.count() == 1 and late.count() == 0


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError):
        runtime.shared_dir(Session())
