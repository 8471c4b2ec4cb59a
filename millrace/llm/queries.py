"""Queries of the language-model training-data problems, by name, and their SQL where it can be told."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.strings import folded, plain_hash, stripped
from millrace.llm import clusters, increments, mixing, overlaps, quality, splits, tokens
from millrace.operators import packed
from millrace.runtime import cut, scratch, spread
from millrace.sources.tables import table

TOLERANCES = {"spectral_centroid_mean": 30.0, "rms_mean": 0.004, "zcr_mean": 0.003, "spectral_bandwidth_mean": 30.0}


def _clusters(spark: SparkSession, d: str) -> clusters.Clusters:
    return clusters.Clusters(table(spark, d, "audio_features", "audio_id", *TOLERANCES), "audio_id", TOLERANCES)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d).membership(least_size=5).withColumnRenamed("id", "audio_id")


def p1_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Size and most typical records of each cluster, loose ones split around their medoids."""
    return _clusters(spark, d).describe(least_size=5)


EVALUATION = ("val", "test", "holdout_gold")


#: Two of 64 places leave an equal run of 21 digits, which windows of 10 k-grams of 12 digits can't miss.
GRAM, WINDOW = 12, 10


def _split_records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Listed records with their ids' normal form, those with a whole hash, and the overlapping pairs of hashes and of ids."""
    listed = table(spark, d, "split_ids", "audio_id", "split_name", "pool").where("audio_id IS NOT NULL").distinct()
    listed = listed.where(F.col("split_name").isin("train", *EVALUATION))
    # the look-alikes O for 0, I and L for 1; hyphens go
    alike = F.translate(F.lower(stripped(F.col("audio_id"))), "oil-", "011")
    listed = cut(listed.withColumn("alike", alike), "listed")
    hashes = table(spark, d, "audio_manifest", "audio_id", "sha256").select("audio_id", plain_hash(F.col("sha256")).alias("sha"))
    held = listed.join(hashes.where("sha RLIKE '^[0-9a-f]{64}$'"), "audio_id").select("audio_id", "split_name", "pool", "alike", "sha").distinct()
    held = cut(held, "held")
    text = lambda df, c, train: df.where(F.col("split_name") == "train" if train else F.col("split_name") != "train").select(F.col(c).alias("text"))
    by_hash = overlaps.text_overlaps(text(held, "sha", False), text(held, "sha", True), GRAM, WINDOW, 62 / 64, in_place=True).where("length(a) = length(b) AND matched >= length(a) - 2")
    # ids must be equal, which needs no fingerprints
    by_id = cut(overlaps.equal_texts(text(listed, "alike", False), text(listed, "alike", True)), "equal")
    return listed, held, by_hash.select("a", "b"), by_id.select("a", "b")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    listed, held, by_hash, by_id = _split_records(spark, d)

    def pairs(df: DataFrame, text: str, of: DataFrame) -> DataFrame:
        df = df.select("audio_id", "split_name", F.col(text).alias("text")).distinct()
        train = df.where("split_name = 'train'").select("audio_id", "text")
        return overlaps.expand(of, df.where("split_name <> 'train'"), train).select("a_audio_id", "b_audio_id", "a_split_name")

    o = pairs(held, "sha", by_hash).unionByName(pairs(listed, "alike", by_id)).toDF("a", "b", "split_name")
    return o.select(F.least("a", "b").alias("audio_id_1"), F.greatest("a", "b").alias("audio_id_2"), "split_name").distinct()


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps, and evaluation records with one, per split and pool (null pool by itself).

    Pairs are counted from the sizes of classes of equal ids and equal hashes, and not made: those alike by id and those by
    hash, less those alike by both. A record with several hashes counts once with each.
    """
    listed, held, by_hash, by_id = _split_records(spark, d)
    evaluated = lambda df: df.where("split_name <> 'train'")
    train = held.where("split_name = 'train'").select("audio_id", "alike", "sha").distinct()
    n_id = by_id.join(listed.where("split_name = 'train'").groupBy(F.col("alike").alias("b")).agg(F.count_distinct("audio_id").alias("n")), "b").groupBy(F.col("a").alias("alike")).agg(F.sum("n").alias("n_id"))
    n_hash = by_hash.join(train.groupBy(F.col("sha").alias("b")).agg(F.count("*").alias("n")), "b").groupBy(F.col("a").alias("sha")).agg(F.sum("n").alias("n_hash"))
    both = by_hash.join(train.groupBy("alike", F.col("sha").alias("b")).agg(F.count("*").alias("n")), "b").groupBy("alike", F.col("a").alias("sha")).agg(F.sum("n").alias("n_both"))
    found = evaluated(held).join(n_hash, "sha").join(both, ["alike", "sha"], "left")
    found = found.groupBy("audio_id", "split_name", "pool").agg(F.sum(F.col("n_hash") - F.coalesce("n_both", F.lit(0))).alias("n_other"), F.sum("n_hash").alias("by_hash"))
    rows = evaluated(listed).join(n_id, "alike", "left").alias("l")
    on = (F.col("l.audio_id") == found["audio_id"]) & (F.col("l.split_name") == found["split_name"]) & F.col("l.pool").eqNullSafe(found["pool"])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = rows.join(found, on, "left").select("l.split_name", "l.pool", zero("n_id").alias("by_id"), zero("by_hash").alias("by_hash"), (zero("n_id") + zero("n_other")).alias("pairs"))
    hit = F.count_if(F.col("pairs") > 0)
    return rows.groupBy("split_name", "pool").agg(
        F.count("*").alias("records"), hit.alias("overlapping"), F.sum("pairs").alias("pairs"), F.sum("by_id").alias("same_id"), F.sum("by_hash").alias("same_content"), (hit / F.count("*")).alias("share")
    )


def _imports(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "audio_manifest", "audio_id", "sha256", "file_bytes", "import_timestamp").where("audio_id IS NOT NULL")
    return m.select(F.col("audio_id").alias("id"), F.col("import_timestamp").alias("ts"), plain_hash(F.col("sha256")).alias("sha"), F.col("file_bytes").alias("bytes")).distinct()


#: Consecutive import batches are taken together, so that there are so many steps.
HISTORY_STEPS = 3


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Import batches in order of time, consecutive ones together, each against the stored history of those before it."""
    records = cut(_imports(spark, d), "imports")
    at = [i / HISTORY_STEPS for i in range(1, HISTORY_STEPS)]
    # the times that part the steps: batches stay whole, as one shares one time; null times come first
    parts = records.agg(F.percentile_approx("ts", F.array(*[F.lit(x) for x in at]), F.lit(10_000)).alias("t")).first()["t"]
    parts = sorted(set(parts or ()))
    step = F.lit(0)
    for t in parts:
        step = step + F.coalesce(F.col("ts") > F.lit(t), F.lit(False)).cast("int")
    folder = scratch(spark, "history")
    out = None
    for i in range(len(parts) + 1):
        got = increments.History(folder).add(records.where(step == i))
        out = got if out is None else out.unionByName(got)
    return out.select(F.least("id", "repeats").alias("audio_id_1"), F.greatest("id", "repeats").alias("audio_id_2")).distinct()


def _track_links(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "dataset_joined", "track_id", "artist_id")
    return splits.record_entities(t, "track_id", splits.number_in(F.col("artist_id")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    groups = splits.entity_groups(_track_links(spark, d))
    sizes = groups.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group")
    return groups.join(sizes, "group").select(F.col("record").alias("track_id"), F.col("group").alias("group_artist"))


SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


def p6_splits(spark: SparkSession, d: str) -> DataFrame:
    """The split of every track; a track without an artist is a group of its own. Labels are first genres."""
    rows = table(spark, d, "dataset_joined", "track_id", "tags").where("track_id IS NOT NULL").distinct()
    items = packed.unpack(rows, F.col("track_id"), F.col("tags"), packed.TAGS).where(F.col("item").startswith("genre---"))
    genre = items.groupBy(F.col("record_key").alias("track_id")).agg(F.min(F.struct("pos", "item"))["item"].alias("label"))
    groups = splits.entity_groups(_track_links(spark, d)).select(F.col("record").alias("track_id"), "group")
    tracks = rows.select("track_id").distinct().join(genre, "track_id", "left").join(groups, "track_id", "left")
    tracks = cut(tracks.select("track_id", "label", F.coalesce(F.concat(F.lit("artist:"), F.col("group").cast("string")), F.concat(F.lit("track:"), "track_id")).alias("unit"), "group"), "tracks")
    chosen = splits.assign(tracks.groupBy("unit", "label").agg(F.count("*").alias("n")), SHARES)
    return tracks.join(chosen, "unit").select("track_id", F.col("group").alias("group_artist"), "label", "split")


def p6_shares(spark: SparkSession, d: str) -> DataFrame:
    """Tracks and share reached per split, and the mean deviation of its label distribution from the whole's."""
    got = cut(p6_splits(spark, d).groupBy("split", F.coalesce("label", F.lit("")).alias("label")).agg(F.count("*").alias("n")), "shares")
    total = got.agg(F.sum("n")).first()[0] or 0
    part = got.join(got.groupBy("label").agg((F.sum("n") / F.lit(total)).alias("p")), "label")
    per = part.join(got.groupBy("split").agg(F.sum("n").alias("tracks")), "split")
    # labels that a split lacks deviate by their whole share: 1 less the shares of those it has
    dev = (1 + F.sum(F.abs(F.col("n") / F.col("tracks") - F.col("p")) - F.col("p"))) / 2
    target = F.create_map(*[F.lit(x) for kv in SHARES.items() for x in kv])
    out = per.groupBy("split", "tracks").agg((F.first("tracks") / F.lit(total)).alias("share"), dev.alias("label_deviation"))
    return out.select("split", "tracks", target[F.col("split")].alias("target_share"), "share", "label_deviation")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_texts(spread(table(spark, d, "documents", "doc_id", "text")))


def _mix(spark: SparkSession, d: str) -> mixing.Mix:
    targets = mixing.read_targets(table(spark, d, "mix_targets"))
    docs = table(spark, d, "documents", "doc_id", "source", "text").withColumn("source", folded(F.col("source")))
    docs = spread(docs.where(F.col("source").isin(list(targets))))
    sized = tokens.count_tokens(docs).select(F.col("doc_id").alias("key"), "source", F.col("tokens").alias("size"))
    return mixing.Mix(cut(sized, "sizes"), targets)


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The documents to take, with their tokens and repeats."""
    return _mix(spark, d).chosen.select(F.col("key").alias("doc_id"), "source", F.col("size").alias("tokens"), "repeats")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share per source."""
    return _mix(spark, d).shares()


def _statistics(spark: SparkSession, d: str) -> DataFrame:
    words = quality.common_words(table(spark, d, "common_words", "word"))
    return quality.text_statistics(spread(table(spark, d, "documents", "doc_id", "text")), words)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _statistics(spark, d).where("kind <> 'prose'").select("doc_id", "kind")


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _statistics(spark, d)


QUERIES = {
    "p1_found": p1_found,
    "p1_clusters": p1_clusters,
    "p5_found": p5_found,
    "p5_report": p5_report,
    "p6_found": p6_found,
    "p6_splits": p6_splits,
    "p6_shares": p6_shares,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_statistics": p10_statistics,
}

_HASH_SQL = r"trim(regexp_replace(lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')), '^sha256:', ''))"
_OVERLAPS_SQL = f"""
s AS (SELECT DISTINCT audio_id, split_name, pool, replace(translate(lower(regexp_replace(audio_id, '^\\s+|\\s+$', '', 'g')), 'oil', '011'), '-', '') x FROM split_ids WHERE audio_id IS NOT NULL),
h AS (SELECT DISTINCT s.*, m.sha FROM s JOIN (SELECT audio_id, {_HASH_SQL} sha FROM audio_manifest) m USING (audio_id) WHERE regexp_full_match(m.sha, '[0-9a-f]{{64}}')),
o AS (SELECT DISTINCT a.audio_id a, b.audio_id b, a.split_name, a.pool, 'id' k FROM s a JOIN s b ON a.x = b.x WHERE a.split_name IN ('val', 'test', 'holdout_gold') AND b.split_name = 'train'
  UNION SELECT DISTINCT a.audio_id, b.audio_id, a.split_name, a.pool, 'hash' FROM h a JOIN h b ON hamming(a.sha, b.sha) <= 2 WHERE a.split_name IN ('val', 'test', 'holdout_gold') AND b.split_name = 'train')"""

ORACLE: dict[str, str] = {
    "p1_found": """
WITH RECURSIVE f AS (SELECT DISTINCT audio_id, spectral_centroid_mean c, rms_mean r, zcr_mean z, spectral_bandwidth_mean b FROM audio_features
  WHERE audio_id IS NOT NULL AND isfinite(spectral_centroid_mean) AND isfinite(rms_mean) AND isfinite(zcr_mean) AND isfinite(spectral_bandwidth_mean)),
e AS (SELECT DISTINCT p.audio_id a, q.audio_id b FROM f p JOIN f q ON abs(p.c - q.c) <= 30 AND abs(p.r - q.r) <= 0.004 AND abs(p.z - q.z) <= 0.003 AND abs(p.b - q.b) <= 30),
l(a, c, n) AS (SELECT a, min(b), 0 FROM e GROUP BY 1 UNION ALL SELECT e.a, min(l.c), any_value(l.n) + 1 FROM e JOIN l ON e.b = l.a WHERE l.n < 60 GROUP BY 1),
g AS (SELECT a, min(c) c FROM l GROUP BY 1)
SELECT g.a AS audio_id, g.c AS cluster_id FROM g WHERE g.c IN (SELECT g.c FROM g JOIN f ON f.audio_id = g.a GROUP BY 1 HAVING count(*) >= 5)""",
    "p5_found": f"WITH {_OVERLAPS_SQL} SELECT DISTINCT least(a, b) AS audio_id_1, greatest(a, b) AS audio_id_2, split_name FROM o",
    "p5_report": f"""
WITH {_OVERLAPS_SQL}, p AS (SELECT a, split_name, pool, count(DISTINCT b) n, count(*) FILTER (k = 'id') i, count(*) FILTER (k = 'hash') c FROM o GROUP BY 1, 2, 3)
SELECT s.split_name, s.pool, count(*) AS records, count(p.n) AS overlapping, coalesce(sum(p.n), 0)::BIGINT AS pairs, coalesce(sum(p.i), 0)::BIGINT AS same_id, coalesce(sum(p.c), 0)::BIGINT AS same_content, count(p.n) / count(*) AS share
FROM s LEFT JOIN p ON s.audio_id = p.a AND s.split_name = p.split_name AND s.pool IS NOT DISTINCT FROM p.pool WHERE s.split_name IN ('val', 'test', 'holdout_gold') GROUP BY 1, 2""",
    "p6_found": r"""
WITH RECURSIVE t AS (SELECT DISTINCT track_id, TRY_CAST(regexp_replace(artist_id, '[^0-9]+', '', 'g') AS BIGINT) a FROM dataset_joined WHERE track_id IS NOT NULL),
u AS (SELECT * FROM t WHERE a IS NOT NULL), e AS (SELECT DISTINCT p.a x, q.a y FROM u p JOIN u q USING (track_id)),
l(x, y, n) AS (SELECT x, min(y), 0 FROM e GROUP BY 1 UNION ALL SELECT e.x, min(l.y), any_value(l.n) + 1 FROM e JOIN l ON e.y = l.x WHERE l.n < 200 GROUP BY 1),
g AS (SELECT x, min(y) y FROM l GROUP BY 1), r AS (SELECT DISTINCT u.track_id, g.y FROM u JOIN g ON u.a = g.x)
SELECT track_id, y AS group_artist FROM r WHERE y IN (SELECT y FROM r GROUP BY 1 HAVING count(*) > 1)""",
}
