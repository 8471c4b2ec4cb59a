"""Standard names of tags, exact by index, else by containment either way; what they mean, and how often they stand."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import normal_tag
from millrace.functions.vocabulary import BUILT_IN, INDEXES, Vocabulary


def alias_table(spark: SparkSession, indexes: Mapping[str, Mapping[str, str]] = INDEXES) -> DataFrame:
    """``(family, alias, standard, ord)`` of the vocabularies: a few hundred rows, whatever the data's size."""
    rows = [(f, a, s, i) for f, index in indexes.items() for i, (a, s) in enumerate(index.items())]
    return spark.createDataFrame(rows, "family string, alias string, standard string, ord int")


def _literal_map(entries: Mapping[str, Column], kind: str) -> Column:
    """A map column of literals; an empty one of the given type."""
    return F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), v)]) if entries else F.create_map().cast(f"map<string, {kind}>")


def standardise(df: DataFrame, tag: str, family: str, vocabulary: Vocabulary = BUILT_IN) -> DataFrame:
    """Adds ``standard``, ``matched`` and what the standard name means: ``program``; or ``valence``, ``arousal`` and
    ``dominance``; or ``level1`` to ``level3``, by family.

    A tag's normal form is looked up; one that isn't there matches the first alias that contains it or is contained in
    it. Each distinct tag is matched once, against the vocabulary as a literal of bounded size, and joined back. Null and
    empty normal forms match nothing. Repeated rows are kept.
    """
    index = vocabulary.indexes[family]
    tags = df.select(F.col(tag).alias("_tag")).where("_tag IS NOT NULL").distinct().withColumn("_n", normal_tag(F.col("_tag")))
    exact = _literal_map({a: F.lit(s) for a, s in index.items()}, "string")
    entries = F.array(*[F.struct(F.lit(a).alias("alias"), F.lit(s).alias("standard")) for a, s in index.items()])
    loose = F.filter(entries, lambda e: F.contains(F.col("_n"), e["alias"]) | F.contains(e["alias"], F.col("_n")))
    found = F.when(F.col("_n") != "", F.coalesce(exact[F.col("_n")], F.get(loose, 0)["standard"])) if index else F.lit(None).cast("string")
    tags = tags.select("_tag", found.alias("standard"))
    out = df.join(tags, F.col(tag) == F.col("_tag"), "left").drop("_tag").withColumn("matched", F.col("standard").isNotNull())
    return out.withColumns(meaning(F.col("standard"), family, vocabulary))


def meaning(standard: Column, family: str, vocabulary: Vocabulary = BUILT_IN) -> dict[str, Column]:
    """The columns that tell what a standard name of a family means; null for a null name."""
    if family == "instrument":
        return {"program": _literal_map({k: F.lit(v) for k, v in vocabulary.instruments.items()}, "int")[standard]}
    if family == "mood":
        vad = _literal_map({k: F.array(*[F.lit(float(x)) for x in v]) for k, v in vocabulary.moods.items()}, "array<double>")[standard]
        return {n: F.get(vad, i) for i, n in enumerate(("valence", "arousal", "dominance"))}
    levels = _literal_map({k: F.array(*[F.lit(x) for x in v]) for k, v in vocabulary.genres.items()}, "array<string>")[standard]
    return {f"level{i + 1}": F.get(levels, i) for i in range(3)}


def blacklisted(tag: Column, vocabulary: Vocabulary = BUILT_IN) -> Column:
    """Whether a tag's normal form is that of a blacklisted one; null and empty ones aren't."""
    n = normal_tag(tag)
    bad = F.array(*[normal_tag(F.lit(b)) for b in vocabulary.blacklist]) if vocabulary.blacklist else F.array().cast("array<string>")
    return F.coalesce((n != "") & F.array_contains(bad, n), F.lit(False))


def map_tags(tags: Column, vocabulary: Vocabulary = BUILT_IN) -> Column:
    """A struct of what a list of tags means: programs (sorted set), moods and genres (in order), unmapped ones.

    Tags are stripped and lower-cased, blacklisted ones dropped; each goes to the first of instruments, moods and genres
    that has its name. Genre names compare in lower case, too. A null list gives empty ones.
    """
    programs, moods, genres = vocabulary.instruments, list(vocabulary.moods), [g.lower() for g in vocabulary.genres]
    clean = F.filter(F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.trim(F.lower(t))), lambda t: t.isNotNull() & ~t.isin(*vocabulary.blacklist))
    of = _literal_map({k: F.lit(v) for k, v in programs.items()}, "int")
    inst = lambda t: t.isin(*programs)
    return F.struct(
        F.array_sort(F.array_distinct(F.transform(F.filter(clean, inst), lambda t: of[t]))).alias("programs"),
        F.filter(clean, lambda t: ~inst(t) & t.isin(*moods)).alias("moods"),
        F.filter(clean, lambda t: ~inst(t) & ~t.isin(*moods) & t.isin(*genres)).alias("genres"),
        F.filter(clean, lambda t: ~inst(t) & ~t.isin(*moods) & ~t.isin(*genres)).alias("unmapped"),
    )


def program_texts(programs: Column, vocabulary: Vocabulary = BUILT_IN) -> Column:
    """"code:name, code:name" of a list of programs, of several names the last; unknown codes as "unknown_gm(code)"."""
    names = {v: k for k, v in vocabulary.instruments.items()}
    of = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.array_join(F.transform(programs, lambda p: F.coalesce(F.concat(p.cast("string"), F.lit(":"), of[p]), F.concat(F.lit("unknown_gm("), p.cast("string"), F.lit(")")))), ", ")


def mood_texts(moods: Column, vocabulary: Vocabulary = BUILT_IN) -> Column:
    """"name (V:0.85,A:0.7,D:0.6) | ..." of a list of moods; of an unknown one the name alone."""
    text = _literal_map({k: F.lit(f" (V:{v[0]:g},A:{v[1]:g},D:{v[2]:g})") for k, v in vocabulary.moods.items()}, "string")
    return F.array_join(F.transform(moods, lambda m: F.concat(m, F.coalesce(text[m], F.lit("")))), " | ")


def genre_texts(genres: Column, vocabulary: Vocabulary = BUILT_IN, none: str = "unmapped") -> Column:
    """"name: level1 > level2 > level3; ..." of a list of genres, and a fixed text for an empty one."""
    text = _literal_map({k.lower(): F.lit(f": {' > '.join(v)}") for k, v in vocabulary.genres.items()}, "string")
    return F.when(F.size(genres) > 0, F.array_join(F.transform(genres, lambda g: F.concat(g, F.coalesce(text[F.lower(g)], F.lit("")))), "; ")).otherwise(F.lit(none))


def reverse_index(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """``(value, key)``: the last key of each value, in ``order`` (ties to the greatest key); null values are left out."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.max(F.struct(F.col(order).alias("o"), F.col(key).alias("k")))["k"].alias(key))


def frequency(df: DataFrame, tag: str, reference: str, order: str) -> DataFrame:
    """``(tag, n, sample)``: how often each tag stands, and the first row's reference (by ``order``, then reference)."""
    return df.where(F.col(tag).isNotNull()).groupBy(tag).agg(F.count("*").alias("n"), F.min(F.struct(F.col(order).alias("o"), F.col(reference).alias("r")))["r"].alias("sample"))


def most_frequent(df: DataFrame, tag: str, reference: str, order: str, k: int = 20) -> DataFrame:
    """The ``k`` most frequent of ``frequency``, the most frequent first, ties by tag (a report)."""
    return frequency(df, tag, reference, order).orderBy(F.desc("n"), tag).limit(k)


def most_likely(scores: Column, k: int = 5) -> Column:
    """The ``k`` entries (name, score) of greatest score of a map from names to scores, ties by name; null for a null map."""
    entries = F.transform(F.map_entries(scores), lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("name")))
    return F.transform(F.slice(F.array_sort(entries), 1, k), lambda e: F.struct(e["name"].alias("name"), (-e["s"]).alias("score")))
