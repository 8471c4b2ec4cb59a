"""Validation and quality gates: ladders of rules over one row, without a shuffle.

Hard rules make a row fail and are listed in ``reasons``; soft ones only mark it, in ``warnings``. All thresholds are parameters.
Null measurements trip no rule unless a rule says so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tripped(rules: Sequence[tuple[Column, Column]]) -> Column:
    """The texts of the rules whose condition holds, in order."""
    return F.filter(F.array(*[F.when(c, t) for c, t in rules]), lambda x: x.isNotNull())


def first_tripped(rules: Sequence[tuple[Column, Column]]) -> Column:
    """The text of the first rule whose condition holds, else null."""
    return F.coalesce(*[F.when(c, t) for c, t in rules])


@dataclass(frozen=True)
class IngestRules:
    formats: tuple[str, ...] = ("wav", "flac", "mp3", "m4a", "ogg")
    lossy: tuple[str, ...] = ("mp3", "m4a", "ogg")
    min_duration: float = 1
    max_duration: float = 600
    max_bytes: int = 200 * 1024 * 1024
    min_sample_rate: int = 44100


def ingest_check(df: DataFrame, fmt: Column, duration: Column, size: Column, rate: Column, channels: Column, readable: Column | None = None, rules: IngestRules = IngestRules()) -> DataFrame:
    """Adds ``ok``, ``reason`` of the first rule that fails, and ``tags`` that lower quality but don't reject.

    A null format is unsupported; a null duration, size or rate isn't judged. Rejected rows have no tags.
    """
    hard = [
        (~F.coalesce(readable, F.lit(True)) if readable is not None else F.lit(False), F.lit("corrupted_file")),
        (~F.coalesce(F.lower(fmt).isin(*rules.formats), F.lit(False)), F.concat(F.lit("unsupported_format: "), F.coalesce(F.lower(fmt), F.lit("")))),
        (duration < rules.min_duration, F.lit("too_short")),
        (duration > rules.max_duration, F.lit("too_long")),
        (size > rules.max_bytes, F.lit("too_large")),
    ]
    soft = [
        (rate < rules.min_sample_rate, F.concat(F.lit("low_sample_rate:"), rate.cast("string"))),
        (channels == 1, F.lit("mono_audio")),
        (F.lower(fmt).isin(*rules.lossy), F.lit("lossy_format")),
    ]
    df = df.withColumn("reason", first_tripped(hard))
    return df.withColumn("ok", F.col("reason").isNull()).withColumn("tags", F.when(F.col("ok"), tripped(soft)).otherwise(F.array().cast("array<string>")))


def routed(df: DataFrame, ok: str = "ok") -> tuple[DataFrame, DataFrame]:
    """The rows that pass and those that don't (a null verdict doesn't pass)."""
    good = F.coalesce(F.col(ok), F.lit(False))
    return df.where(good), df.where(~good)


@dataclass(frozen=True)
class QualityRules:
    min_duration: float = 5
    max_duration: float = 600
    min_sample_rate: int = 44100
    min_bit_depth: int = 16
    silence: float = 0.99
    silence_warning: float = 0.7
    clipping: float = 0.05
    snr: float = 15
    dynamic_range: float = 10
    flatness: float = 0.5


def quality_gate(df: DataFrame, m: Mapping[str, Column], rules: QualityRules = QualityRules()) -> DataFrame:
    """Adds ``reasons``, ``warnings`` and ``passed`` from those of the measures in ``m`` that are there.

    Measures: corrupted, duration, sample_rate, bit_depth, silence_ratio, clipping_ratio, snr_db, dynamic_range_db. A
    sample rate or bit depth of 0 is unknown. NaN trips nothing, infinities compare as they are.
    """
    known = lambda c: ~F.isnan(c.cast("double"))
    low, high = [], []
    if "corrupted" in m:
        low.append((m["corrupted"], F.lit("corrupted")))
    if "duration" in m:
        low.append(((m["duration"] < rules.min_duration) & known(m["duration"]), F.lit("too_short")))
        if rules.max_duration > 0:
            high.append(((m["duration"] > rules.max_duration) & known(m["duration"]), F.lit("too_long")))
    if "sample_rate" in m:
        low.append(((m["sample_rate"] > 0) & (m["sample_rate"] < rules.min_sample_rate), F.lit("low_sample_rate")))
    if "bit_depth" in m:
        high.append(((m["bit_depth"] > 0) & (m["bit_depth"] < rules.min_bit_depth), F.lit("low_bit_depth")))
    if "silence_ratio" in m:
        s = m["silence_ratio"]
        low.append(((s >= rules.silence) & known(s), F.lit("silent")))
        high.append(((s > rules.silence_warning) & (s < rules.silence), F.lit("high_silence")))
    if "clipping_ratio" in m:
        low.append(((m["clipping_ratio"] > rules.clipping) & known(m["clipping_ratio"]), F.lit("clipping")))
    if "snr_db" in m:
        high.append((m["snr_db"] < rules.snr, F.lit("low_snr")))
    if "dynamic_range_db" in m:
        high.append((m["dynamic_range_db"] < rules.dynamic_range, F.lit("low_dynamic_range")))
    df = df.withColumn("reasons", tripped(low)).withColumn("warnings", tripped(high))
    return df.withColumn("passed", F.size("reasons") == 0)


def noise_candidate(snr: Column, flatness: Column, rules: QualityRules = QualityRules()) -> tuple[Column, Column]:
    """(candidate, reason): a signal-to-noise ratio above 0 and below the limit, or too flat a spectrum."""
    tests = [((snr > 0) & (snr < rules.snr), F.lit("snr")), ((flatness > rules.flatness) & ~F.isnan(flatness), F.lit("spectral_flatness"))]
    found = tripped(tests)
    return F.size(found) > 0, F.concat_ws("; ", found)


def bit_depth(subtype: Column) -> Column:
    """The bits of a subtype as PCM_16 names it; floats have 32, others 0."""
    n = F.regexp_extract(F.upper(subtype), r"(?:PCM_?|S|U)(8|16|24|32|64)", 1)
    return F.when(n != "", n.cast("int")).when(F.upper(subtype).contains("FLOAT"), F.lit(32)).when(F.upper(subtype).contains("DOUBLE"), F.lit(64)).otherwise(F.lit(0))


def repairs(fmt: Column, rate: Column, channels: Column, target: str = "wav", target_rate: int = 44100, target_channels: int = 2) -> Column:
    """What has to change for a file to have the target format, as "field:from>to"."""
    part = lambda name, c, to: (c != F.lit(to), F.concat(F.lit(f"{name}:"), c.cast("string"), F.lit(f">{to}")))
    return tripped([part("format", F.lower(fmt), target), part("sample_rate", rate, target_rate), part("channels", channels, target_channels)])


# fixed values: words of a file name that tell it isn't music
NON_MUSIC_WORDS = (
    "speech", "interview", "podcast", "lecture", "seminar", "presentation", "meeting", "conversation", "dialogue",
    "语音", "访谈", "播客", "讲座", "演讲", "会议", "对话",
    "noise", "silence", "ambient", "environment", "field_recording", "噪声", "静音", "环境音", "现场录音",
)


def music_rules(silence: Column, duration: Column, file_name: Column, flatness: Column, silent: float = 0.7, short: float = 3.0, flat: float = 0.5) -> Column:
    """The first rule that tells a file isn't music, as (score, confidence, rule); null if none does."""
    out = lambda s, c, r: F.struct(F.lit(s).alias("score"), F.lit(c).alias("confidence"), F.lit(r).alias("rule"))
    word = F.lit(False)
    for w in NON_MUSIC_WORDS:
        word = word | F.contains(F.lower(file_name), F.lit(w))
    return (
        F.when((silence > silent) & ~F.isnan(silence), out(0.1, 0.8, "silence"))
        .when(duration < short, out(0.2, 0.7, "short"))
        .when(word, out(0.15, 0.75, "file_name"))
        .when((flatness > flat) & ~F.isnan(flatness), out(0.2, 0.6, "flat_spectrum"))
    )


def music_score(rhythm_cv: Column, mfcc_std: Column, harmonic: Column, zcr: Column) -> tuple[Column, Column]:
    """(score, confidence): four part scores weighted .6, .5, .5 and .4."""
    peak = lambda x, lo, hi, at, width, other: F.when((x > lo) & (x < hi), F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.abs(x - at) / width))).otherwise(F.lit(other))
    parts = [(peak(rhythm_cv, 0.2, 1.0, 0.5, 0.5, 0.2), 0.6), (F.least(F.lit(1.0), mfcc_std / 50.0), 0.5), (peak(harmonic, 0.3, 0.9, 0.6, 0.4, 0.3), 0.5), (peak(zcr, 0.02, 0.4, 0.15, 0.2, 0.3), 0.4)]
    weight = sum(w for _, w in parts) + 1e-10
    score = F.lit(0.0)
    for s, w in parts:
        score = score + s * F.lit(w)
    return score / F.lit(weight), F.lit(weight / len(parts))


def content_rejects(is_music: Column, has_speech: Column, has_noise: Column, reject_speech: bool = True, reject_noise: bool = True) -> Column:
    """Not music, and speech or noise of a kind to reject; nulls count as music without either."""
    no = lambda c: F.coalesce(c, F.lit(False))
    return ~F.coalesce(is_music, F.lit(True)) & ((F.lit(reject_speech) & no(has_speech)) | (F.lit(reject_noise) & no(has_noise)))


def language_gate(lang: Column, confidence: Column, allowed: Sequence[str], least: float) -> tuple[Column, Column]:
    """(allowed, note): whether the language is one of ``allowed`` (null isn't), and a note on a low confidence."""
    note = F.when(confidence < least, F.concat(F.lit("low_confidence:"), F.format_string("%.3f", confidence)))
    return F.coalesce(lang.isin(*allowed), F.lit(False)), note


def missing_flags(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """"missing_a;missing_c;": the columns that are null or NaN in a row, in the table's order."""
    kinds = dict(df.dtypes)
    gone = lambda c: F.isnan(c) | F.col(c).isNull() if kinds[c] in ("double", "float") else F.col(c).isNull()
    return F.concat_ws("", *[F.when(gone(c), F.lit(f"missing_{c};")) for c in columns or df.columns])


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> tuple[DataFrame, DataFrame]:
    """``df`` with defaults for nulls, and the number of values filled per column; unknown columns are left out."""
    known = {c: v for c, v in defaults.items() if c in df.columns}
    filled = df.select(*[F.coalesce(F.col(c), F.lit(known[c])).alias(c) if c in known else F.col(c) for c in df.columns])
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in known])
    return filled, counts


def required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows that have a value, other than null and NaN, in each of those of the columns that the table has."""
    there = [c for c in columns if c in df.columns]
    return df.na.drop(subset=there) if there else df


def content_gate(is_music: Column, is_instrumental: Column, vocal_ratio: Column, is_safe: Column, instrumental_only: bool = False, max_vocal_ratio: float = 1.0, music: bool = True, safety: bool = True) -> tuple[Column, Column]:
    """(passed, reason of the first rule that fails): music, only instruments, not too much singing, safe.

    A null ratio isn't judged, and a null verdict counts as music, as not instrumental, and as safe.
    """
    reason = first_tripped([
        (F.lit(music) & ~F.coalesce(is_music, F.lit(True)), F.lit("not_music")),
        (F.lit(instrumental_only) & ~F.coalesce(is_instrumental, F.lit(False)), F.lit("not_instrumental")),
        ((vocal_ratio > max_vocal_ratio) & ~F.isnan(vocal_ratio), F.lit("too_vocal")),
        (F.lit(safety) & ~F.coalesce(is_safe, F.lit(True)), F.lit("unsafe")),
    ])
    return reason.isNull(), reason


def vocal_gate(ratio: Column, estimate: Column, unsure: str = "run", low: float = 0.3, high: float = 0.7, least: float = 0.10) -> tuple[Column, Column]:
    """(decision, go on): whether an item has singing, by two thresholds on a detector's ratio.

    Between them ``unsure`` tells: "run" and "check" go on, the latter only where ``estimate`` is above ``least``; "skip"
    and "mark" don't. Without a ratio (null or NaN) the estimate alone tells, a null one counts as singing.
    """
    if unsure not in ("run", "check", "skip", "mark"):
        raise ValueError(f"no strategy {unsure}")
    known = ratio.isNotNull() & ~F.isnan(ratio)
    sung = F.coalesce(estimate > least, F.lit(True))
    decision = F.when(~known, "estimated").when(ratio > high, "vocals").when(ratio < low, "no_vocals").otherwise("unsure")
    between = {"run": F.lit(True), "check": sung}.get(unsure, F.lit(False))
    return decision, F.when(~known, sung).when(ratio > high, F.lit(True)).when(ratio < low, F.lit(False)).otherwise(between)


def transcription_route(lang: Column, has_stem: Column, first: Sequence[str], targets: Sequence[str] = (), first_tool: bool = True, second_tool: bool = True) -> tuple[Column, Column]:
    """(status, tool): skipped_language, no_vocals, no_tool or ready; languages in ``first`` take the first tool where there is one."""
    wanted = lang.isin(*targets) if targets else F.lit(True)
    second = F.when(F.lit(second_tool), F.lit("second"))
    tool = F.when(lang.isin(*first) & F.lit(first_tool), F.lit("first")).otherwise(second)
    status = F.when(~F.coalesce(wanted, F.lit(False)), "skipped_language").when(~F.coalesce(has_stem, F.lit(False)), "no_vocals").when(tool.isNull(), "no_tool").otherwise("ready")
    return status, F.when(status == "ready", tool)


def segment_end(duration: Column, default: int = 10) -> Column:
    """Whole seconds of a duration, or a default where it is null, NaN or not above 0."""
    return F.when((duration > 0) & ~F.isnan(duration), F.floor(duration)).otherwise(F.lit(default)).cast("int")


def vocal_ratio(band: Column, flux: Column | None = None, harmonic: Column | None = None) -> Column:
    """The singing share of a band's energy with the spectral flux (.7 and .3, the flux at most 1 and halved), or with the
    harmonic share (.4 and .6), between 0 and 1."""
    if harmonic is not None:
        raw = F.lit(0.6) * harmonic + F.lit(0.4) * band
    else:
        raw = F.lit(0.7) * band + F.lit(0.3) * (F.least(F.lit(1.0), flux / 10.0) * 0.5)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))
