"""Queries of packed fields, tags and redaction, and the SQL that each is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text, vocabulary
from millrace.operators import packed, tags
from millrace.plans.book import Book
from millrace.runtime import spread
from millrace.sources.tables import table

BOOK = Book()
query = BOOK.query

# packed fields: a mark is put where a delimiter run counts, and quotes are taken off each part

_TRIM = r"regexp_replace({0}, '^[ \t\n\r,;|]+|[ \t\n\r,;|]+$', '', 'g')"
_BARE = "CASE " + " ".join(f"WHEN length(p) > 1 AND p[1] = {q} AND p[-1] = {q} THEN replace(p[2:-2], {q} || {q}, {q})" for q in ("chr(34)", "chr(39)")) + " ELSE p END"


def _packed_sql(table_name: str, key: str, column: str, mark: str) -> str:
    inner = _TRIM.format(column)
    boxed = f"CASE WHEN {inner}[1] = '[' AND {inner}[-1] = ']' THEN {inner}[2:-2] ELSE {inner} END"
    parts = f"SELECT {key} k, string_split({mark.format(f'({_TRIM.format(boxed)})')}, chr(1)) l FROM {table_name}"
    flat = f"SELECT k, unnest(l) p, generate_subscripts(l, 1) i FROM ({parts})"
    clean = rf"SELECT k, i, regexp_replace({_BARE}, '^\s+|\s+$', '', 'g') item FROM (SELECT k, i, regexp_replace(p, '^[ \t\n\r,;|]+|[ \t\n\r,;|]+$', '', 'g') p FROM ({flat}))"
    return f"SELECT '{table_name}' AS table_name, k AS record_key, row_number() OVER (PARTITION BY k, r ORDER BY i) AS pos, item FROM (SELECT *, min(i) OVER (PARTITION BY k) r FROM ({clean}) WHERE item <> '')"


_MARK_TAGS = r"""regexp_replace({0}, '[ \t\n\r,;|]+(["'']?(?:genre|instrument|mood)---)', chr(1) || '\1', 'g')"""
_MARK_LANGS = r"""regexp_replace({0}, '[ \t\n\r,;|]*[\t\n\r,;|][ \t\n\r,;|]*(["'']?[A-Za-z_-]+:[0-9.])', chr(1) || '\1', 'g')"""
_MARK_EVENTS = r"""regexp_replace({0}, '(:[0-9]+["'']?)[ \t\n\r,;|]*[\t\n\r,;|][ \t\n\r,;|]*', '\1' || chr(1), 'g')"""

_TAG_ROWS = _packed_sql("(SELECT DISTINCT track_id, tags FROM dataset_joined)", "track_id", "tags", _MARK_TAGS).replace("'(SELECT DISTINCT track_id, tags FROM dataset_joined)' AS table_name", "'dataset_joined' AS table_name")

PACKED_SQL = " UNION ALL ".join([
    _TAG_ROWS,
    _packed_sql("(SELECT DISTINCT audio_path, lang_top5 FROM language_cache)", "audio_path", "lang_top5", _MARK_LANGS).replace("'(SELECT DISTINCT audio_path, lang_top5 FROM language_cache)' AS", "'language_cache' AS"),
    _packed_sql("(SELECT DISTINCT track_id, yamnet_top_tags FROM yamnet_output)", "track_id", "yamnet_top_tags", _MARK_EVENTS).replace("'(SELECT DISTINCT track_id, yamnet_top_tags FROM yamnet_output)' AS", "'yamnet_output' AS"),
])


# tags


def _items(spark: SparkSession, d: str, kind: str) -> DataFrame:
    rows = table(spark, d, "dataset_joined", "track_id", "tags").distinct()
    items = packed.unpack(rows, F.col("track_id"), F.col("tags"), packed.TAGS)
    return items.where(F.col("item").startswith(kind + "---")).select(F.col("record_key").alias("track_id"), "pos", F.expr(f"substring(item, {len(kind) + 4})").alias("tag"))


def _items_sql(kind: str) -> str:
    return f"SELECT record_key track_id, pos, item[{len(kind) + 4}:] tag FROM ({_TAG_ROWS}) WHERE starts_with(item, '{kind}---')"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _standard_sql(kind: str, values: dict[str, str], columns: str) -> str:
    index = ", ".join(f"({i}, {_text(a)}, {_text(s)})" for i, (a, s) in enumerate(vocabulary.INDEXES[kind].items()))
    means = ", ".join(f"({_text(k)}, {v})" for k, v in values.items())
    return f"""
WITH v(o, alias, standard) AS (VALUES {index}), w(standard, {columns}) AS (VALUES {means}), i AS ({_items_sql(kind)}),
t AS (SELECT DISTINCT tag, trim(regexp_replace(lower(tag), '[ _&-]', '', 'g')) n FROM i),
m AS (SELECT tag, arg_min(standard, CASE WHEN n = alias THEN o - 100000 ELSE o END) standard FROM t, v WHERE n <> '' AND (contains(n, alias) OR contains(alias, n)) GROUP BY 1)
SELECT i.track_id, i.pos, i.tag, m.standard, m.standard IS NOT NULL AS matched, {columns} FROM i LEFT JOIN m USING (tag) LEFT JOIN w ON m.standard = w.standard"""


@query(_standard_sql("instrument", {k: str(v) for k, v in vocabulary.INSTRUMENTS.items()}, "program"))
def standard_instruments(spark: SparkSession, d: str) -> DataFrame:
    return tags.standardise(_items(spark, d, "instrument"), "tag", "instrument")


@query(_standard_sql("mood", {k: ", ".join(f"{x}::DOUBLE" for x in v) for k, v in vocabulary.MOODS.items()}, "valence, arousal, dominance"))
def standard_moods(spark: SparkSession, d: str) -> DataFrame:
    return tags.standardise(_items(spark, d, "mood"), "tag", "mood")


@query(_standard_sql("genre", {k: ", ".join(map(_text, v)) for k, v in vocabulary.GENRES.items()}, "level1, level2, level3"))
def standard_genres(spark: SparkSession, d: str) -> DataFrame:
    return tags.standardise(_items(spark, d, "genre"), "tag", "genre")


def _list(names) -> str:
    return "[" + ", ".join(_text(n) for n in names) + "]"


_MAPPED_SQL = f"""
SELECT track_id, list_sort(list_distinct(list_transform(list_filter(c, lambda t: list_contains(i, t)), lambda t: (MAP {{{", ".join(f"{_text(k)}: {v}" for k, v in vocabulary.INSTRUMENTS.items())}}})[t]))) AS programs,
  list_filter(c, lambda t: NOT list_contains(i, t) AND list_contains(m, t)) AS moods,
  list_filter(c, lambda t: NOT list_contains(i, t) AND NOT list_contains(m, t) AND list_contains(g, t)) AS genres,
  list_filter(c, lambda t: NOT list_contains(i, t) AND NOT list_contains(m, t) AND NOT list_contains(g, t)) AS unmapped
FROM (SELECT track_id, list_filter(list_transform(l, lambda t: trim(lower(t))), lambda t: NOT list_contains({_list(vocabulary.BLACKLIST)}, t)) c,
  {_list(vocabulary.INSTRUMENTS)} i, {_list(vocabulary.MOODS)} m, {_list(g.lower() for g in vocabulary.GENRES)} g
  FROM (SELECT track_id, list_sort(list(DISTINCT tag)) l FROM ({_items_sql("instrument")} UNION ALL {_items_sql("mood")} UNION ALL {_items_sql("genre")}) GROUP BY 1))"""
_MAPPED_AS_TEXT = f"SELECT track_id, array_to_string(programs, ',') AS programs, array_to_string(moods, ',') AS moods, array_to_string(genres, ',') AS genres, array_to_string(unmapped, ',') AS unmapped FROM ({_MAPPED_SQL})"


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    rows = _items(spark, d, "instrument").unionByName(_items(spark, d, "mood")).unionByName(_items(spark, d, "genre"))
    rows = rows.groupBy("track_id").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    return rows.select("track_id", tags.map_tags(F.col("tags")).alias("m")).select("track_id", "m.*")


@query(_MAPPED_AS_TEXT)
def mapped_tags(spark: SparkSession, d: str) -> DataFrame:
    m = _mapped(spark, d)
    return m.select("track_id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("programs", "moods", "genres", "unmapped")])


@query(f"""
SELECT track_id, array_to_string(list_transform(programs, lambda p: coalesce(p || ':' || (MAP {{{", ".join(f"{v}: {_text(k)}" for v, k in {v: k for k, v in vocabulary.INSTRUMENTS.items()}.items())}}})[p], 'unknown_gm(' || p || ')')), ', ') AS program_text,
  array_to_string(list_transform(moods, lambda x: x || (MAP {{{", ".join(f"{_text(k)}: {_text(f' (V:{v[0]:g},A:{v[1]:g},D:{v[2]:g})')}" for k, v in vocabulary.MOODS.items())}}})[x]), ' | ') AS mood_text,
  CASE WHEN len(genres) > 0 THEN array_to_string(list_transform(genres, lambda x: x || (MAP {{{", ".join(f"{_text(k.lower())}: {_text(': ' + ' > '.join(v))}" for k, v in vocabulary.GENRES.items())}}})[x]), '; ') ELSE 'unmapped' END AS genre_text
FROM ({_MAPPED_SQL})""")
def label_texts(spark: SparkSession, d: str) -> DataFrame:
    m = _mapped(spark, d)
    return m.select("track_id", tags.program_texts(F.col("programs")).alias("program_text"), tags.mood_texts(F.col("moods")).alias("mood_text"), tags.genre_texts(F.col("genres")).alias("genre_text"))


@query(f"""
SELECT record_key AS track_id, item AS tag, list_contains(['lofi', 'polka'], regexp_replace(lower(item), '[ _&-]', '', 'g')) AS dropped
FROM (SELECT track_id record_key, tag item FROM ({_items_sql("genre")}))""")
def blacklisted_tags(spark: SparkSession, d: str) -> DataFrame:
    bad = vocabulary.Vocabulary(blacklist=("Lo-Fi", "polka"))
    return _items(spark, d, "genre").select("track_id", "tag", tags.blacklisted(F.col("tag"), bad).alias("dropped"))


@query(f"SELECT tag, count(*) AS n, min(track_id) AS sample FROM ({_items_sql('genre')}) GROUP BY 1 ORDER BY n DESC, tag LIMIT 20")
def top_genres(spark: SparkSession, d: str) -> DataFrame:
    """The twenty most frequent genres: a report."""
    return tags.most_frequent(_items(spark, d, "genre"), "tag", "track_id", "track_id", 20)


# redaction

# SQL without look-behinds: each run of digits is put between marks, so that a whole run is told from a part of one
_RUNS = r"regexp_replace({0}, '(\d+)', chr(1) || '\1' || chr(1), 'g')"
_OCTET = r"(?:25[0-5]|2[0-4]\d|[01]?\d\d?)"
_MARKED = {
    "phone": r"\x011[3-9]\d{9}\x01",
    "id_card": r"\x01\d{18}\x01|\x01\d{17}\x01[Xx]",
    "email": None,
    "bank_card": r"\x01\d{16,19}\x01",
    "landline": r"\x010\d{9,11}\x01|\x010\d{2,3}\x01[-\s]\x01\d{7,8}\x01",
    "ip_address": rf"\x01{_OCTET}\x01\.\x01{_OCTET}\x01\.\x01{_OCTET}\x01\.\x01{_OCTET}\x01",
    "url": None,
    "mac_address": None,
    "chinese_address": None,
}


def _pii_sql() -> str:
    inner = "SELECT doc_id, text AS t0 FROM documents"
    for i, (kind, pattern) in enumerate(text.PII):
        marked = _MARKED[kind]
        src = _RUNS.format(f"t{i}") if marked else f"t{i}"
        p = _text(marked or pattern)
        put = f"regexp_replace({src}, {p}, '[REDACTED]', 'g')"
        put = f"replace({put}, chr(1), '')" if marked else put
        inner = f"SELECT *, len(regexp_extract_all(coalesce({src}, ''), {p})) n{i}, {put} t{i + 1} FROM ({inner})"
    n = " + ".join(f"n{i}" for i in range(len(text.PII)))
    kinds = ", ".join(f"CASE WHEN n{i} > 0 THEN '{k}:' || n{i} END" for i, (k, _) in enumerate(text.PII))
    return f"SELECT doc_id, t{len(text.PII)} AS clean, ({n})::INT AS removed, concat_ws('; ', {kinds}) AS types FROM ({inner})"


@query(_pii_sql())
def pii_redacted(spark: SparkSession, d: str) -> DataFrame:
    """All nine kinds, one after another."""
    df, kinds = text.redact(spread(table(spark, d, "documents", "doc_id", "text")), "text")
    n = {k: F.col(f"n_{k}") for k in kinds}
    return df.select("doc_id", F.col("text").alias("clean"), text.total(n).alias("removed"), text.type_list(n).alias("types"))
