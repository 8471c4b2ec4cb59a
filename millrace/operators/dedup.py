"""Exact and near duplicates: groups, pairs, and which copy to keep under each of several policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.graph import accepted_in_order
from millrace.runtime import cut

#: Splits by how much a copy in them is worth keeping.
PRIORITY = {"holdout_gold": 4, "holdout": 4, "test": 3, "val": 2, "train": 1}


def keep_first(df: DataFrame, hash_: str, order: list[Column]) -> DataFrame:
    """The first row of each hash in ``order`` (a total one); rows without a hash are unique and all kept."""
    cols = [F.col(c) for c in df.columns]
    keyed = df.where(F.col(hash_).isNotNull())
    first = keyed.groupBy(F.col(hash_).alias("_h")).agg(F.min_by(F.struct(*cols), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("r"))
    return first.select("r.*").unionByName(df.where(F.col(hash_).isNull()))


def exact_groups(df: DataFrame, hash_: str, key: str, size: str) -> DataFrame:
    """``(hash, keep, n)`` of hashes held by several keys: the largest is kept, of equal ones the least key.

    The other keys are those of ``exact_links``. Null hashes and keys, and repeated rows, make no duplicates.
    """
    rows = df.where(F.col(hash_).isNotNull() & F.col(key).isNotNull()).groupBy(hash_, key).agg(F.max(size).alias("_size"))
    worth = F.struct((-F.coalesce(F.col("_size"), F.lit(-1)).cast("double")).alias("s"), F.col(key).alias("k"))
    return rows.groupBy(F.col(hash_).alias("hash")).agg(F.min(worth)["k"].alias("keep"), F.count("*").alias("n")).where("n > 1")


def exact_links(df: DataFrame, hash_: str, key: str, size: str) -> DataFrame:
    """``(remove, keep)``: each duplicate and the copy kept; a star per hash instead of all its pairs."""
    rows = df.where(F.col(hash_).isNotNull() & F.col(key).isNotNull()).groupBy(hash_, key).agg(F.max(size).alias("_size"))
    worth = F.struct((-F.coalesce(F.col("_size"), F.lit(-1)).cast("double")).alias("s"), F.col(key).alias("k"))
    best = rows.groupBy(F.col(hash_).alias("_h")).agg(F.min(worth)["k"].alias("keep"), F.count("*").alias("_n")).where("_n > 1")
    return rows.join(best, F.col(hash_) == F.col("_h")).where(F.col(key) != F.col("keep")).select(F.col(key).alias("remove"), "keep")


def greedy(pairs: DataFrame, items: DataFrame, key: str, quality: list[str]) -> DataFrame:
    """``(remove, keep, similarity)``: pairs resolved one after another in the order of the keys.

    An item that is still in is compared with each later one that is in; of two the one worse by ``quality`` (the first
    that differs, the greater is better) is out, of equal ones the later. An item that loses goes on with its later
    partners. ``pairs`` is (id_1, id_2, similarity), id_1 < id_2, each once.

    An item has its turn unless an earlier one that had its turn beats it. So turns are settled by rounds over the pairs
    in which the earlier beats the later, and a pair is met if the first has its turn and the second hasn't lost before.
    """
    q = items.select(F.col(key).alias("id"), F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in quality]).alias("q")).groupBy("id").agg(F.max("q").alias("q"))
    rows = pairs.join(q.toDF("id_1", "q1"), "id_1").join(q.toDF("id_2", "q2"), "id_2")
    rows = cut(rows.select("id_1", "id_2", "similarity", (F.col("q1") >= F.col("q2")).alias("first_wins")), "duels")
    nodes = rows.select("id_1").union(rows.select("id_2")).distinct().select(F.col("id_1").alias("id"), F.lit(None).cast("string").alias("clique"), F.col("id_1").alias("rank"))
    turn = accepted_in_order(nodes, rows.where("first_wins").select(F.col("id_2").alias("late"), F.col("id_1").alias("early"))).where("ok").select(F.col("id").alias("id_1"))
    met = rows.join(turn, "id_1")
    lost = met.where("first_wins").groupBy("id_2").agg(F.min("id_1").alias("at"))
    met = met.join(lost, "id_2", "left").where("at IS NULL OR id_1 <= at")
    return met.select(F.when(F.col("first_wins"), F.col("id_2")).otherwise(F.col("id_1")).alias("remove"), F.when(F.col("first_wins"), F.col("id_1")).otherwise(F.col("id_2")).alias("keep"), "similarity")


def stars(pairs: DataFrame, items: DataFrame, key: str, size: str) -> DataFrame:
    """``(group_id, id, keep, similarity)``: in key order, each item not yet taken takes all its neighbours not yet taken.

    Groups aren't transitive. The largest of a group is kept (ties to the least key); similarity is to the kept one, 1 for itself, null
    where the two aren't similar. The items that take others are settled by rounds over all pairs; what is taken belongs
    to the first of them. ``pairs`` is (id_1, id_2, similarity), id_1 < id_2, each once.
    """
    rows = cut(pairs.select("id_1", "id_2", "similarity"), "pairs")
    nodes = rows.select("id_1").union(rows.select("id_2")).distinct().select(F.col("id_1").alias("id"), F.lit(None).cast("string").alias("clique"), F.col("id_1").alias("rank"))
    centre = accepted_in_order(nodes, rows.select(F.col("id_2").alias("late"), F.col("id_1").alias("early"))).where("ok").select("id")
    taken = rows.join(centre.toDF("id_1"), "id_1").groupBy(F.col("id_2").alias("id")).agg(F.min("id_1").alias("group_id"))
    members = taken.select("group_id", "id").unionByName(taken.select("group_id", F.col("group_id").alias("id")).distinct())
    s = items.select(F.col(key).alias("id"), F.coalesce(F.col(size).cast("double"), F.lit(0.0)).alias("s")).groupBy("id").agg(F.max("s").alias("s"))
    members = cut(members.join(s, "id"), "members")
    keep = members.groupBy("group_id").agg(F.min(F.struct((-F.col("s")).alias("s"), "id"))["id"].alias("keep"))
    both = rows.unionByName(rows.select(F.col("id_2").alias("id_1"), F.col("id_1").alias("id_2"), "similarity"))
    out = members.join(keep, "group_id").select("group_id", "id", "keep")
    sim = both.select(F.col("id_1").alias("keep"), F.col("id_2").alias("id"), "similarity")
    return out.join(sim, ["keep", "id"], "left").select("group_id", "id", "keep", F.when(F.col("id") == F.col("keep"), F.lit(1.0)).otherwise(F.col("similarity")).alias("similarity"))


def segments(df: DataFrame, key: str, length: Column, chunk: float, overlap: float, least: float = 1.0) -> DataFrame:
    """``(key, n, start, end)``: windows of ``chunk``, ``chunk * (1 - overlap)`` apart; the tail is left out.

    An item shorter than a window has one, of itself; segments under ``least`` are left out.
    """
    hop = chunk * (1 - overlap)
    n = F.greatest(F.lit(1), F.floor((length - F.lit(chunk)) / F.lit(hop)) + 1).cast("int")
    rows = df.select(F.col(key), length.alias("_len"), F.explode(F.sequence(F.lit(0), n - 1)).alias("n"))
    start = F.col("n") * F.lit(hop)
    rows = rows.select(key, "n", start.alias("start"), F.least(start + F.lit(chunk), F.col("_len")).alias("end"))
    return rows.where(F.col("end") - F.col("start") >= least)


def segment_pairs(features: DataFrame, key: str, n: str, vector: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(pairs of similar segments of different items, number of such pairs per pair of items).

    ``features`` holds one vector per item and segment number; the pairs are ``(id_1, n_1, id_2, n_2, similarity)``, the
    lesser item first, and the numbers ``(id_1, id_2, matching)``.
    """
    from millrace.operators.similarity import similar_pairs

    # one key for item and number: a struct's order is that of its fields, and equal items never pair
    rows = features.where(F.col(key).isNotNull()).select(F.struct(F.col(key).alias("item"), F.col(n).alias("n")).alias("k"), F.col(key).cast("string").alias("item"), F.col(vector).alias("v"))
    number = cut(rows.select("k", "item", "v", F.xxhash64("k").alias("code")), "segments")
    found = similar_pairs(number, "code", "v", threshold, apart="item")
    named = number.select("code", "k")
    p = found.join(named.toDF("id_1", "a"), "id_1").join(named.toDF("id_2", "b"), "id_2").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")
    p = cut(p.select(F.col("a.item").alias("id_1"), F.col("a.n").alias("n_1"), F.col("b.item").alias("id_2"), F.col("b.n").alias("n_2"), "similarity"), "segment_pairs")
    return p, p.groupBy("id_1", "id_2").agg(F.count("*").alias("matching"))


def split_priority(pairs: DataFrame, splits: DataFrame, key: str, split: str) -> DataFrame:
    """``(id_1, id_2, similarity, keep_in, remove_from)`` of similar pairs in different splits: the worthier split keeps."""
    rank = F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv])
    s = splits.select(F.col(key).alias("id"), F.col(split).alias("s")).distinct()
    rows = pairs.join(s.toDF("id_1", "s1"), "id_1").join(s.toDF("id_2", "s2"), "id_2").where("s1 <> s2")
    first = F.coalesce(rank[F.col("s1")], F.lit(0)) >= F.coalesce(rank[F.col("s2")], F.lit(0))
    return rows.select("id_1", "id_2", "similarity", F.when(first, F.col("s1")).otherwise(F.col("s2")).alias("keep_in"), F.when(first, F.col("s2")).otherwise(F.col("s1")).alias("remove_from"))
