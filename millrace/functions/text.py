"""Redaction, safety scores and tag normal forms as Column expressions: no Python runs per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: kinds of personal data in the order in which they are redacted, one after another
PII: tuple[tuple[str, str], ...] = (
    ("phone", r"(?<!\d)1[3-9]\d{9}(?!\d)"),
    ("id_card", r"(?<!\d)\d{17}[\dXx](?!\d)"),
    ("email", r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"),
    ("bank_card", r"(?<!\d)\d{16,19}(?!\d)"),
    ("landline", r"(?<!\d)0\d{2,3}[-\s]?\d{7,8}(?!\d)"),
    ("ip_address", r"(?<!\d)(?:(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\.){3}(?:25[0-5]|2[0-4]\d|[01]?\d\d?)(?!\d)"),
    ("url", r"""https?://[^\s<>"{}|\\^`\[\]]+"""),
    ("mac_address", r"(?i)(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}"),
    ("chinese_address", r"\d+[一-龥]{0,10}(?:路|街|号|室|栋|单元|巷|弄|大道|大道号)(?:\d+[一-龥]{0,5})?"),
)

# fixed values: words that look like a name but are none
NOT_NAMES = ("国王", "王子", "公主", "皇后", "皇帝", "将军", "大人", "先生", "小姐", "女士", "老师", "同学", "朋友", "家人", "大家", "人们")

# fixed values: keyword categories and patterns with their weights
SAFETY_KEYWORDS: Mapping[str, tuple[float, tuple[str, ...]]] = {
    "violence": (0.8, ("暴力", "血腥", "殴打", "杀人", "谋杀", "恐怖", "袭击", "自残", "自杀")),
    "drugs": (0.9, ("毒品", "吸毒", "贩毒", "海洛因", "可卡因", "大麻", "冰毒", "摇头丸")),
    "political_sensitive": (1.0, ()),
    "pornography": (0.7, ("色情", "淫秽", "成人", "三级", "裸体")),
    "gambling": (0.6, ("赌博", "赌场", "博彩", "下注", "赌球")),
    "fraud": (0.7, ("诈骗", "传销", "非法集资", "骗局", "欺诈")),
    "hate_speech": (0.8, ("歧视", "种族主义", "仇恨", "排外", "性别歧视")),
}
SAFETY_PATTERNS: Mapping[str, tuple[float, str]] = {
    "phone_number": (0.3, r"1[3-9]\d{9}"),
    "id_card": (0.5, r"\d{17}[\dXx]"),
    "bank_card": (0.4, r"\d{16,19}"),
    "url": (0.2, r"""https?://[^\s<>"]+"""),
}


def redact(df: DataFrame, column: str, kinds: Sequence[str] | None = None, replacement: str = "[REDACTED]", prefix: str = "n_") -> tuple[DataFrame, list[str]]:
    """``df`` with ``column`` redacted and a count column per kind, ``prefix`` and its name, each counted on what the kinds before have left.

    One projection per kind, so that a text is searched once for each, and rewritten only where something was found. A
    null text stays null and counts 0. Returns the names of the kinds, too.
    """
    done = []
    put = replacement.replace("\\", "\\\\").replace("$", "\\$")
    for name, pattern in PII:
        if kinds is None or name in kinds:
            n = f"{prefix}{name}"
            df = df.withColumn(n, F.coalesce(F.regexp_count(F.col(column), F.lit(pattern)), F.lit(0)))
            df = df.withColumn(column, F.when(F.col(n) > 0, F.regexp_replace(F.col(column), pattern, put)).otherwise(F.col(column)))
            done.append(name)
    return df, done


def type_list(counts: Mapping[str, Column]) -> Column:
    """Counts that aren't 0 as "kind:count; kind:count"."""
    return F.concat_ws("; ", *[F.when(c > 0, F.concat(F.lit(f"{k}:"), c.cast("string"))) for k, c in counts.items()])


def total(counts: Mapping[str, Column]) -> Column:
    out = F.lit(0)
    for c in counts.values():
        out = out + c
    return out


def chinese_names(text: Column, surnames: str) -> Column:
    """Words of a surname and one or two characters, before anything but a further character, other than known words.

    ``surnames`` is the set of surname characters, as one string.
    """
    found = F.regexp_extract_all(text, F.lit(f"([{surnames}][\\u4e00-\\u9fa5]{{1,2}})(?![\\u4e00-\\u9fa5])"), 1)
    return F.filter(found, lambda x: ~x.isin(*NOT_NAMES))


def redact_names(text: Column, surnames: str, replacement: str = "[REDACTED]") -> Column:
    return F.aggregate(F.array_distinct(chinese_names(text, surnames)), text, lambda acc, n: F.replace(acc, n, F.lit(replacement)))


def safety(
    text: Column,
    keywords: Mapping[str, tuple[float, Sequence[str]]] = SAFETY_KEYWORDS,
    patterns: Mapping[str, tuple[float, str]] = SAFETY_PATTERNS,
    threshold: float = 0.5,
) -> tuple[Column, Column, Column, Column]:
    """(score, matches, level, safe): a keyword adds 0.2 of its weight once, a pattern 0.15 for each match; at most 1.

    Letter case doesn't count. A null text scores 0.
    """
    low = F.lower(text)
    score, matches = F.lit(0.0), F.lit(0)
    for weight, words in keywords.values():
        for w in words:
            hit = F.coalesce(F.contains(low, F.lit(w.lower())), F.lit(False)).cast("int")
            score, matches = score + hit * F.lit(weight * 0.2), matches + hit
    for weight, pattern in patterns.values():
        n = F.coalesce(F.regexp_count(text, F.lit("(?i)" + pattern)), F.lit(0))
        score, matches = score + n * F.lit(weight * 0.15), matches + n
    score = F.least(F.lit(1.0), score)
    return score, matches, risk_level(score), score < threshold


def risk_level(score: Column) -> Column:
    return F.when(score == 0, "safe").when(score < 0.3, "low").when(score < 0.6, "medium").otherwise("high")


def any_word(text: Column, words: Sequence[str]) -> Column:
    """Whether a text holds one of the words anywhere, in whatever letter case; a null text holds none."""
    low, hit = F.lower(text), F.lit(False)
    for w in words:
        hit = hit | F.contains(low, F.lit(w.lower()))
    return F.coalesce(hit, F.lit(False))


def normal_tag(c: Column) -> Column:
    """Lower case, without blanks, hyphens, underscores and ampersands."""
    return F.trim(F.regexp_replace(F.lower(c), r"[ \-_&]", ""))


def python_list(c: Column) -> Column:
    """A list written as a Python literal of strings; what can't be read is an empty list."""
    return F.coalesce(F.from_json(c, "array<string>", {"allowSingleQuotes": "true"}), F.array().cast("array<string>"))
