"""Connected components of an edge table, by alternating star operations.

Each round rewires every node's larger neighbours to its least one and then its smaller ones, so that a component of
diameter d becomes a star around its least node in about log d rounds. Only the edge table lives between rounds, in the
shared folder; minima are folded on the map side, so that a node with very many edges forms no large group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.runtime import Table


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("v").alias("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")).select("x.*")


def _state(t: DataFrame) -> tuple:
    return tuple(t.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, src: str, dst: str, max_rounds: int = 100) -> DataFrame:
    """``(id, component)`` for every node with an edge to another; the component is its least id.

    Loops, repeated edges and edges with a null end change nothing. An empty table gives no rows.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = Table(e, "edges")
    state = _state(now.df)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        n = _both_ways(now.df)
        least = n.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = n.where("v > u").join(least, F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small_least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        pairs = large.join(small_least, F.col("u") == F.col("k"))
        # a node and each of its smaller neighbours go to the least of them
        to = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        new = Table(pairs.select(F.explode(to).alias("x")).select("x.*").where("u <> v").distinct(), "edges")
        was, state = state, _state(new.df)
        now.drop()
        now = new
        if state == was:
            break
    else:
        raise RuntimeError(f"not settled after {max_rounds} rounds")
    stars = now.df
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(stars.select("v", "v").distinct())


def accepted_in_order(nodes: DataFrame, edges: DataFrame, cliques: bool = False, max_rounds: int = 10_000) -> DataFrame:
    """``(id, clique, rank, ok)``: nodes taken one after another by ``rank``; one is accepted unless it has an accepted neighbour.

    ``nodes`` is (id, clique, rank), ranks being distinct; ``edges`` (late, early), early being of the lower rank. With
    ``cliques`` the nodes of one clique (null is none) are neighbours of one another without an edge: only a clique's earliest accepted and earliest
    open node matter, so that no clique forms a large group. In a round every node is settled whose earlier neighbours
    are, and edges of settled nodes go; rounds are as many as the longest chain of open neighbours, which for nodes in no
    particular order grows with the logarithm of their number.
    """
    state, s = None, nodes.select("id", "clique", "rank", F.lit(None).cast("boolean").alias("ok"))
    for _ in range(max_rounds):
        early = edges.join(s.select(F.col("id").alias("early"), "ok"), "early").groupBy(F.col("late").alias("id")).agg(
            F.max(F.coalesce(F.col("ok"), F.lit(False))).alias("hit"), F.max(F.col("ok").isNull()).alias("wait")
        )
        n = s.join(early, "id", "left")
        hit, wait = F.coalesce("hit", F.lit(False)), F.coalesce("wait", F.lit(False))
        if cliques:
            lead = s.where("clique IS NOT NULL").groupBy("clique").agg(F.min(F.when(F.col("ok"), F.col("rank"))).alias("taken"), F.min(F.when(F.col("ok").isNull(), F.col("rank"))).alias("open"))
            n = n.join(lead, "clique", "left")
            hit = hit | F.coalesce(F.col("taken") < F.col("rank"), F.lit(False))
            wait = wait | F.coalesce(F.col("open") < F.col("rank"), F.lit(False))
        ok = F.when(F.col("ok").isNotNull(), F.col("ok")).when(hit, F.lit(False)).when(~wait, F.lit(True))
        after = Table(n.select("id", "clique", "rank", ok.alias("ok")), "state", count=F.col("ok").isNull())
        if state is not None:
            state.drop()
        state, s = after, after.df
        if not state.counted:
            return s
    raise RuntimeError(f"not settled after {max_rounds} rounds")
