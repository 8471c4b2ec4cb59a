"""Queries of gates, reports and measured signals, and the SQL that each is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text, vectors
from millrace.functions.vectors import doubles
from millrace.operators import density, gates, kernels, reports, signal, tags
from millrace.plans.book import Book
from millrace.runtime import spread
from millrace.sources.tables import table

BOOK = Book()
query = BOOK.query


# gates


@query("SELECT doc_id, lang, source FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def required_fields(spark: SparkSession, d: str) -> DataFrame:
    return gates.required(table(spark, d, "documents", "doc_id", "lang", "source"), ["lang", "source", "absent"])


@query("SELECT audio_id, file_bytes FROM audio_manifest WHERE audio_id IN (SELECT audio_id FROM split_ids WHERE split_name = 'test')")
def listed_only(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "split_ids", "audio_id", "split_name").where("split_name = 'test'").select("audio_id")
    return table(spark, d, "audio_manifest", "audio_id", "file_bytes").join(s, "audio_id", "left_semi")


@query("""
SELECT track_id, r IS NULL AS passed, r AS reason FROM (SELECT track_id, CASE WHEN NOT coalesce(is_music, true) THEN 'not_music' WHEN coalesce(has_vocals, true) THEN 'not_instrumental'
  WHEN vocals_ratio > 0.02 AND NOT isnan(vocals_ratio) THEN 'too_vocal' WHEN coalesce(has_noise, false) THEN 'unsafe' END r FROM yamnet_output)""")
def instrumental_gate(spark: SparkSession, d: str) -> DataFrame:
    y = table(spark, d, "yamnet_output", "track_id", "is_music", "has_vocals", "vocals_ratio", "has_noise")
    ok, why = gates.content_gate(F.col("is_music"), ~F.coalesce("has_vocals", F.lit(True)), F.col("vocals_ratio"), ~F.coalesce("has_noise", F.lit(False)), instrumental_only=True, max_vocal_ratio=0.02)
    return y.select("track_id", ok.alias("passed"), why.alias("reason"))


@query("""
SELECT track_id, CASE WHEN r IS NULL OR isnan(r) THEN 'estimated' WHEN r > 0.3 THEN 'vocals' WHEN r < 0.05 THEN 'no_vocals' ELSE 'unsure' END AS decision,
  CASE WHEN r IS NULL OR isnan(r) THEN coalesce(e > 0.1, true) WHEN r > 0.3 THEN true WHEN r < 0.05 THEN false ELSE coalesce(e > 0.1, true) END AS go_on
FROM (SELECT track_id, vocals_ratio r, vocals_ratio_estimate e FROM yamnet_output)""")
def vocal_decisions(spark: SparkSession, d: str) -> DataFrame:
    decision, go = gates.vocal_gate(F.col("vocals_ratio"), F.col("vocals_ratio_estimate"), "check", 0.05, 0.3)
    return table(spark, d, "yamnet_output", "track_id", "vocals_ratio", "vocals_ratio_estimate").select("track_id", decision.alias("decision"), go.alias("go_on"))


@query("""
SELECT audio_path, lang, s AS status, CASE WHEN s = 'ready' THEN CASE WHEN lang IN ('zh', 'yue') THEN 'first' ELSE 'second' END END AS tool FROM (SELECT audio_path, lang,
  CASE WHEN NOT coalesce(lang IN ('zh', 'yue', 'en', 'de'), false) THEN 'skipped_language' WHEN NOT coalesce(lang_allowed, false) THEN 'no_vocals' ELSE 'ready' END s FROM language_cache)""")
def transcription_routes(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "language_cache", "audio_path", "lang", "lang_allowed")
    status, tool = gates.transcription_route(F.col("lang"), F.col("lang_allowed"), ("zh", "yue"), ("zh", "yue", "en", "de"))
    return c.select("audio_path", "lang", status.alias("status"), tool.alias("tool"))


@query("SELECT audio_id, duration_s, CASE WHEN duration_s > 0 AND NOT isnan(duration_s) THEN floor(duration_s)::INT ELSE 10 END AS end_s FROM audio_features")
def segment_ends(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "audio_features", "audio_id", "duration_s").select("audio_id", "duration_s", gates.segment_end(F.col("duration_s")).alias("end_s"))


@query("""
SELECT track_id, round(greatest(0, least(1, 0.7 * vocals_ratio + 0.3 * least(1.0, noise_ratio / 10.0) * 0.5)), 9)::DOUBLE AS by_flux,
  round(greatest(0, least(1, 0.6 * music_ratio + 0.4 * vocals_ratio)), 9)::DOUBLE AS by_harmonics
FROM yamnet_output WHERE isfinite(vocals_ratio) AND isfinite(noise_ratio) AND isfinite(music_ratio)""")
def vocal_ratios(spark: SparkSession, d: str) -> DataFrame:
    y = table(spark, d, "yamnet_output", "track_id", "vocals_ratio", "noise_ratio", "music_ratio")
    for c in y.columns[1:]:
        y = y.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return y.select("track_id", F.round(gates.vocal_ratio(F.col("vocals_ratio"), F.col("noise_ratio")), 9).alias("by_flux"), F.round(gates.vocal_ratio(F.col("vocals_ratio"), harmonic=F.col("music_ratio")), 9).alias("by_harmonics"))


@query("SELECT doc_id, len(list_filter(['guitar', '录音', 'tape'], lambda w: contains(lower(coalesce(text, '')), w))) > 0 AS hit FROM documents")
def word_hits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", text.any_word(F.col("text"), ("Guitar", "录音", "tape")).alias("hit"))


# reports

WORDS = {"gear": (0.8, ("tape", "reverb")), "parts": (0.9, ("guitar", "录音", "chorus"))}
NUMBERS = {"year": (0.3, r"(19|20)\d{2}"), "url": (0.2, r"https?://")}


def _risk(column: str) -> tuple[str, str]:
    t = f"lower(coalesce({column}, ''))"
    score = [f"{w * 0.2} * CAST(contains({t}, '{k}') AS INT)" for w, ks in WORDS.values() for k in ks] + [f"{w * 0.15} * len(regexp_extract_all(coalesce({column}, ''), '(?i){p}'))" for w, p in NUMBERS.values()]
    n = [f"CAST(contains({t}, '{k}') AS INT)" for _, ks in WORDS.values() for k in ks] + [f"len(regexp_extract_all(coalesce({column}, ''), '(?i){p}'))" for _, p in NUMBERS.values()]
    return f"least(1.0, {' + '.join(score)})", " + ".join(n)


@query(f"""
SELECT doc_id, round(m, 6)::DOUBLE AS max_risk, n::INT AS matches, concat_ws('; ', CASE WHEN a >= 0.3 THEN 'text' END, CASE WHEN b >= 0.3 THEN 'source' END) AS unsafe_columns,
  CASE WHEN m = 0 THEN 'safe' WHEN m < 0.3 THEN 'low' WHEN m < 0.6 THEN 'medium' ELSE 'high' END AS risk_level, m < 0.3 AS is_safe
FROM (SELECT *, greatest(a, b) m FROM (SELECT doc_id, {_risk("text")[0]} a, {_risk("source")[0]} b, {_risk("text")[1]} + {_risk("source")[1]} n FROM documents))""")
def text_risk_report(spark: SparkSession, d: str) -> DataFrame:
    """Over two columns, with tables of words and patterns that the texts hold."""
    r = reports.risk_report(table(spark, d, "documents", "doc_id", "text", "source"), ["text", "source", "absent"], 0.3, keywords=WORDS, patterns=NUMBERS)
    return r.select("doc_id", F.round("max_risk", 6).alias("max_risk"), "matches", "unsafe_columns", "risk_level", "is_safe")


_URL, _MAIL = r"https?://[^\s<>\"{}|\\^`\[\]]+", r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"


def _count(column: str, pattern: str) -> str:
    return f"len(regexp_extract_all(coalesce({column}, ''), '{pattern}'))::INT"


@query(f"""
WITH c AS (SELECT doc_id, text, 'mail ' || doc_id || '@x.org, ' || coalesce(source, '') s FROM documents), m AS (SELECT doc_id, {_count("text", _MAIL)} a, {_count("s", _MAIL)} b, regexp_replace(text, '{_MAIL}', '[REDACTED]', 'g') text, regexp_replace(s, '{_MAIL}', '[REDACTED]', 'g') s FROM c),
u AS (SELECT *, {_count("text", _URL)} e, {_count("s", _URL)} f FROM m)
SELECT doc_id, a + e AS text_removed, b + f AS note_removed, a + b + e + f AS total_removed, concat_ws('; ', CASE WHEN a > 0 THEN 'email:' || a END, CASE WHEN e > 0 THEN 'url:' || e END) AS text_types,
  concat_ws('; ', CASE WHEN a + b > 0 THEN 'email:' || (a + b) END, CASE WHEN e + f > 0 THEN 'url:' || (e + f) END) AS all_types FROM u""")
def redaction_report(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text", "source").withColumn("note", F.concat(F.lit("mail "), F.col("doc_id"), F.lit("@x.org, "), F.coalesce("source", F.lit(""))))
    r = reports.redaction_report(spread(docs), ["text", "note"], ("email", "url"))
    return r.select("doc_id", "text_removed", "note_removed", "total_removed", "text_types", "all_types")


@query("SELECT count(*) AS total, count(*) FILTER (status = 'active') AS success, count(*) FILTER (status IN ('failed', 'rejected')) AS failed, count(*) FILTER (status IS NULL OR status NOT IN ('active', 'failed', 'rejected')) AS skipped FROM audio_manifest")
def status_tallies(spark: SparkSession, d: str) -> DataFrame:
    return reports.tallies(table(spark, d, "audio_manifest", "status"), F.col("status"), ["active"], ["failed", "rejected"])


@query("""
SELECT count(*) AS total, count(*) FILTER (p) AS passed, count(*) FILTER (NOT p) AS failed, count(*) FILTER (r) AS repaired
FROM (SELECT coalesce(duration_sec >= 30, false) p, coalesce(lower(audio_format) <> 'wav' OR sample_rate <> 44100 OR channels <> 2, false) r FROM audio_manifest)""")
def batch_verdicts(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "audio_manifest", "audio_format", "sample_rate", "channels", "duration_sec")
    return reports.verdicts(m, F.col("duration_sec") >= 30, F.size(gates.repairs(F.col("audio_format"), F.col("sample_rate"), F.col("channels"))) > 0)


@query("""
SELECT audio_id, round_even(rms_mean::DECIMAL(38, 18), 4)::DOUBLE AS rms_mean, CASE WHEN isfinite(bpm) THEN round_even(bpm::DECIMAL(38, 18), 2)::DOUBLE ELSE bpm END AS bpm, array_to_string(l[:2], '; ') AS reasons
FROM (SELECT audio_id, rms_mean, bpm, list_filter([CASE WHEN duration_s < 60 THEN 'short' END, CASE WHEN sample_rate < 44100 THEN 'low_rate' END, CASE WHEN n_channels = 1 THEN 'mono' END], lambda x: x IS NOT NULL) l FROM audio_features WHERE isfinite(rms_mean))""".replace("round_even(", "round_even("))
def serialised_report(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "audio_features", "audio_id", "rms_mean", "bpm", "duration_s", "sample_rate", "n_channels").where(F.col("rms_mean").isNotNull() & ~F.isnan("rms_mean") & (F.abs("rms_mean") < float("inf")))
    why = gates.tripped([(F.col("duration_s") < 60, F.lit("short")), (F.col("sample_rate") < 44100, F.lit("low_rate")), (F.col("n_channels") == 1, F.lit("mono"))])
    return reports.serialised(f.withColumn("reasons", why), {"rms_mean": 4, "bpm": 2}, {"reasons": 2}).select("audio_id", "rms_mean", "bpm", "reasons")


@query("""
SELECT user_id, array_to_string(list_transform(l[:3], lambda e: e.t || '=' || round(e.n, 6)::VARCHAR), ', ') AS top FROM (SELECT user_id, list({'t': event_type, 'n': v} ORDER BY v DESC, event_type) l
FROM (SELECT user_id, event_type, round(avg(value), 6) v FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2) GROUP BY 1)""")
def most_likely(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events", "user_id", "event_type", "value").where("event_type IS NOT NULL AND value IS NOT NULL").groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("v"))
    m = e.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("scores"))
    return m.select("user_id", F.array_join(F.transform(tags.most_likely(F.col("scores"), 3), lambda s: F.concat(s["name"], F.lit("="), s["score"].cast("string"))), ", ").alias("top"))


# signals: each vector is taken as a short one, scaled to its peak

FRAME, HOP = 16, 8
_SIGNAL = "SELECT vec_id, list_transform(v, lambda t: t / m) x FROM (SELECT vec_id, v, list_max(list_transform(v, lambda t: abs(t))) m FROM (SELECT vec_id, embedding::DOUBLE[] v FROM embeddings))"
_LEVELS = f"SELECT vec_id, x, list_transform(range(0, (len(x) - {FRAME}) // {HOP} + 1), lambda i: sqrt(list_sum(list_transform(x[i * {HOP} + 1 : i * {HOP} + {FRAME}], lambda t: t * t)) / {FRAME})) l FROM ({_SIGNAL})"


def _signals(spark: SparkSession, d: str) -> DataFrame:
    v = doubles(F.col("embedding"))
    peak = F.array_max(F.transform(v, F.abs))
    e = table(spark, d, "embeddings", "vec_id", "embedding").withColumn("peak", peak)
    return e.select("vec_id", F.transform(v, lambda t: t / F.col("peak")).alias("x"))


@query(f"""
SELECT vec_id, round(list_avg(l), 9) AS rms_mean, round(list_stddev_pop(l), 6) AS rms_std, round(list_max(l), 9) AS rms_max, round(list_min(l), 9) AS rms_min FROM ({_LEVELS})""")
def frame_levels(spark: SparkSession, d: str) -> DataFrame:
    s = _signals(spark, d).withColumn("l", F.transform(signal.frames(F.col("x"), FRAME, HOP), signal.rms))
    m = signal.series_summary(F.col("l"), "rms")
    return s.select("vec_id", *[F.round(c, 6 if n == "rms_std" else 9).alias(n) for n, c in m.items()])


@query(f"""
SELECT vec_id, round(list_avg(list_transform(range(0, (len(x) - {FRAME}) // {HOP} + 1), lambda i: list_sum(list_transform(range(i * {HOP} + 2, i * {HOP} + {FRAME} + 1), lambda j: CASE WHEN (x[j] < 0) <> (x[j - 1] < 0) THEN 1 ELSE 0 END)) / {FRAME})), 9) AS zcr_mean FROM ({_SIGNAL})""")
def zero_crossings(spark: SparkSession, d: str) -> DataFrame:
    s = _signals(spark, d).withColumn("z", F.transform(signal.frames(F.col("x"), FRAME, HOP), signal.crossings))
    return s.select("vec_id", F.round(signal.series_summary(F.col("z"), "zcr")["zcr_mean"], 9).alias("zcr_mean"))


@query(f"""
SELECT vec_id, i::INT AS i, round((1 * (a(i + 1) - a(i - 1)) + 2 * (a(i + 2) - a(i - 2)) + 3 * (a(i + 3) - a(i - 3)) + 4 * (a(i + 4) - a(i - 4))) / 60, 9) AS slope
FROM (SELECT vec_id, x, unnest(range(0, len(x))) i FROM ({_SIGNAL}))""".replace("a(", "AT(").replace("range(0, len(x)))", "range(0, len(x)))"))
def deltas(spark: SparkSession, d: str) -> DataFrame:
    s = _signals(spark, d).select("vec_id", F.posexplode(signal.delta(F.col("x"))).alias("i", "slope"))
    return s.select("vec_id", "i", F.round("slope", 9).alias("slope"))


def _at(sql: str) -> str:
    """AT(i + k) as the place of a list, its ends repeated."""
    import re

    return re.sub(r"AT\((i [+-] \d)\)", r"x[least(len(x), greatest(1, \1 + 1))]", sql)


BOOK.sql["deltas"] = _at(BOOK.sql["deltas"])

_QUALITY_SQL = f"""
SELECT vec_id, len(list_filter(l, lambda t: t < 0.2)) / len(l) AS silence_ratio, len(list_filter(x, lambda t: abs(t) >= 0.9)) / len(x) AS clipping_ratio,
  CASE WHEN len(list_filter(l, lambda t: t >= 0.2)) = 0 THEN 0 WHEN len(list_filter(l, lambda t: t < 0.2)) > 0 THEN 10 * log10(list_avg(list_transform(list_filter(l, lambda t: t >= 0.2), lambda t: t * t)) / list_avg(list_transform(list_filter(l, lambda t: t < 0.2), lambda t: t * t))) ELSE 'inf'::DOUBLE END AS snr_db,
  20 * log10(list_max(l) / list_aggregate(l, 'quantile_cont', 0.05)) AS dynamic_range_db FROM ({_LEVELS})"""


@query(f"SELECT vec_id, round(silence_ratio, 9) AS silence_ratio, round(clipping_ratio, 9) AS clipping_ratio, round(snr_db, 6)::DOUBLE AS snr_db, round(dynamic_range_db, 6) AS dynamic_range_db FROM ({_QUALITY_SQL})")
def signal_quality(spark: SparkSession, d: str) -> DataFrame:
    q = signal.quality(F.col("x"), FRAME, HOP, quiet=0.2, clip=0.9)
    return _signals(spark, d).select("vec_id", *[F.round(c, 9 if n.endswith("ratio") else 6).alias(n) for n, c in q.items()])


@query(f"""
SELECT vec_id, len(r) = 0 AS passed, array_to_string(r, '; ') AS reasons, array_to_string(w, '; ') AS warnings FROM (SELECT vec_id,
  list_filter([CASE WHEN vec_id % 50 = 7 THEN 'corrupted' END, CASE WHEN vec_id % 90 < 5 THEN 'too_short' END, CASE WHEN vec_id % 40 > 0 AND vec_id % 40 * 2000 < 44100 THEN 'low_sample_rate' END, CASE WHEN silence_ratio >= 0.5 THEN 'silent' END, CASE WHEN clipping_ratio > 0.05 THEN 'clipping' END], lambda t: t IS NOT NULL) r,
  list_filter([CASE WHEN vec_id % 90 > 80 THEN 'too_long' END, CASE WHEN vec_id % 30 > 0 AND vec_id % 30 < 16 THEN 'low_bit_depth' END, CASE WHEN silence_ratio > 0.1 AND silence_ratio < 0.5 THEN 'high_silence' END, CASE WHEN snr_db < 8 THEN 'low_snr' END, CASE WHEN dynamic_range_db < 6 THEN 'low_dynamic_range' END], lambda t: t IS NOT NULL) w FROM ({_QUALITY_SQL}))""")
def measured_gate(spark: SparkSession, d: str) -> DataFrame:
    """All eight measures of the gate: those of the signal, and the others from the row's number."""
    v = F.col("vec_id")
    q = signal.quality(F.col("x"), FRAME, HOP, quiet=0.2, clip=0.9)
    rules = gates.QualityRules(min_duration=5, max_duration=80, silence=0.5, silence_warning=0.1, clipping=0.05, snr=8, dynamic_range=6)
    s = _signals(spark, d).withColumns(q)
    measures = {"corrupted": v % 50 == 7, "duration": (v % 90).cast("double"), "sample_rate": (v % 40) * 2000, "bit_depth": v % 30, **{n: F.col(n) for n in q}}
    g = gates.quality_gate(s, measures, rules)
    return g.select("vec_id", "passed", F.array_join("reasons", "; ").alias("reasons"), F.array_join("warnings", "; ").alias("warnings"))


@query(f"""
SELECT vec_id, round(list_sum(list_transform(x[1:32], lambda t: t * t)) / list_sum(list_transform(x, lambda t: t * t)), 9) AS share FROM ({_SIGNAL})""")
def stem_shares(spark: SparkSession, d: str) -> DataFrame:
    return _signals(spark, d).select("vec_id", F.round(signal.stem_share(F.slice("x", 1, 32), F.slice("x", 33, 32)), 9).alias("share"))


@query()
def spectral_features(spark: SparkSession, d: str) -> DataFrame:
    """Spectra; checked against known signals on a fixture."""
    return signal.spectral_features(_signals(spark, d).withColumn("rate", F.lit(64)), "vec_id", "x", "rate", FRAME, HOP)


@query("SELECT vec_id, i::INT AS n, round(e, 6) AS level FROM (SELECT vec_id, unnest(embedding::DOUBLE[]) e, generate_subscripts(embedding, 1) - 1 i FROM embeddings WHERE vec_id % 7 <> 0) WHERE e > 0.1")
def tagged_frames(spark: SparkSession, d: str) -> DataFrame:
    """A kernel that gives any number of rows per row, and fails on every seventh."""

    def load():
        import pandas as pd

        def frames_of(b):
            if (b["vec_id"] % 7 == 0).any():
                raise ValueError("not readable")
            rows = [(r, i, round(float(v), 6)) for r, vec in enumerate(b["embedding"]) for i, v in enumerate(vec) if v > 0.1]
            return pd.DataFrame(rows, columns=["row", "n", "level"])

        return frames_of

    def broken():
        raise ImportError("no such model")

    rows, _ = kernels.expand_kernel(table(spark, d, "embeddings", "vec_id", "embedding"), [broken, load], "n int, level double", ["vec_id"])
    return rows.select("vec_id", "n", F.round("level", 6).alias("level"))


# labels and projections of vectors

_COSINE = "list_cosine_similarity(e.embedding::DOUBLE[], r.embedding::DOUBLE[])"


@query(f"""
SELECT e.vec_id, CASE WHEN r.vec_id IS NULL THEN 'not_found' WHEN {_COSINE} < 0.05 THEN 'mismatch' ELSE 'match' END AS verdict, round({_COSINE}, 4) AS similarity
FROM embeddings e LEFT JOIN (SELECT label, embedding, vec_id FROM embeddings WHERE vec_id IN (SELECT min(vec_id) FROM embeddings WHERE label < 8 GROUP BY label)) r ON e.label = r.label""")
def label_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Each vector against the first of its label, which stands for the label's text; two labels have none."""
    e = table(spark, d, "embeddings", "vec_id", "label", "embedding")
    first = e.where("label < 8").groupBy(F.col("label").alias("name")).agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return density.label_check(e, "vec_id", "label", first, "name", "embedding", 0.05)


@query()
def projected(spark: SparkSession, d: str) -> DataFrame:
    """Two principal components; checked by their variance on a fixture."""
    return density.projection(table(spark, d, "embeddings", "vec_id", "embedding"), "vec_id", "embedding")


# scalars


@query("""
SELECT vec_id, (list_position(v, list_max(v)) - 1)::INT AS top, round(CASE WHEN abs(v[2]) > 0 THEN 10 * log10(abs(v[1]) / abs(v[2])) ELSE 'inf'::DOUBLE END, 6) AS db, greatest(0, least(1, v[1]))::DOUBLE AS clamped,
  round(CASE WHEN v[1] * 10 > -1 THEN pow(10, (-1 - v[1] * 10) / 20) ELSE 1 END, 9)::DOUBLE AS gain FROM (SELECT vec_id, embedding::DOUBLE[] v FROM embeddings)""")
def vector_scalars(spark: SparkSession, d: str) -> DataFrame:
    v = doubles(F.col("embedding"))
    a, b = F.get(v, 0), F.get(v, 1)
    return table(spark, d, "embeddings", "vec_id", "embedding").select(
        "vec_id", vectors.argmax(v).alias("top"), F.round(vectors.decibels(F.abs(a), F.abs(b)), 6).alias("db"), vectors.clamp(a).alias("clamped"), F.round(vectors.peak_gain(a * 10, -1.0), 9).alias("gain")
    )


_SURNAMES = "王李张刘陈杨黄赵吴周"


@query(rf"""
SELECT doc_id, array_to_string(list_filter(regexp_extract_all(regexp_replace(coalesce(text, ''), '([一-龥]+)', '\1' || chr(1), 'g'), '([{_SURNAMES}][一-龥]{{1,2}})\x01', 1), lambda x: NOT list_contains([{", ".join(f"'{w}'" for w in text.NOT_NAMES)}], x)), ',') AS names FROM documents""")
def name_hits(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.array_join(text.chinese_names(t, _SURNAMES), ",").alias("names"))


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang || '|' || source END AS parts FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def literal_lists(spark: SparkSession, d: str) -> DataFrame:
    """Lists as Python writes them; every fifth is broken."""
    docs = table(spark, d, "documents", "doc_id", "lang", "source").where("lang IS NOT NULL AND source IS NOT NULL")
    line = F.when(F.col("doc_id") % 5 == 0, F.lit("oops")).otherwise(F.concat(F.lit("['"), "lang", F.lit("', '"), "source", F.lit("']")))
    return docs.select("doc_id", F.array_join(text.python_list(line), "|").alias("parts"))


@query("SELECT audio_id, coalesce(duration_sec >= 30, false) AS kept FROM audio_manifest")
def routed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that pass and rows that don't, each once."""
    good, bad = gates.routed(table(spark, d, "audio_manifest", "audio_id", "duration_sec").withColumn("ok", F.col("duration_sec") >= 30))
    return good.select("audio_id", F.lit(True).alias("kept")).unionByName(bad.select("audio_id", F.lit(False).alias("kept")))
