"""Train, validation and test splits that keep related records together.

Records tied by an entity, also through records with several entities, form groups: found by iterative minimum-label
propagation over the bipartite record-entity graph. Groups are then assigned so that every split holds its share of each
label: the few groups large enough to matter one by one, greedily by the deviation they cause, all others systematically
along an order in which groups with the same labels lie side by side, so that whatever stretch of it a label or a mixture
of labels takes up is dealt out in the wanted proportions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import global_rank
from millrace.runtime import Table, cut

#: A group with at least this share of all records is placed by itself; there are at most 1 / HEAVY of them.
HEAVY = 0.001
#: The fraction whose multiples spread most evenly over the unit interval.
GOLDEN = (5**0.5 - 1) / 2


def number_in(c: Column) -> Column:
    """The number in an id, without letters, separators, blanks and leading zeros; null without one (or beyond bigint)."""
    return F.regexp_replace(c, r"[^0-9]+", "").try_cast("bigint")


def entity_groups(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(record, group)`` for distinct ``links`` (record, entity); a group is the least entity tied to the record.

    Only records with several entities can tie entities, so only their links are iterated on. In each round a record
    takes the least label of its entities, an entity and the entity that was its label the least label of its records,
    and labels are followed one hop, so that long chains collapse in a logarithmic number of rounds.
    """
    several = links.groupBy("record").agg(F.count("*").alias("k")).where("k > 1").select("record")
    ties = cut(links.join(several, "record"), "ties")
    labels = Table(ties.select("entity", F.col("entity").alias("label")).distinct(), "labels")
    for _ in range(max_rounds):
        known = labels.df
        record = ties.join(known, "entity").groupBy("record").agg(F.min("label").alias("low"))
        seen = ties.join(record, "record").groupBy("entity").agg(F.min("low").alias("low"))
        both = known.join(seen, "entity").select("entity", "label", F.least("label", "low").alias("low"))
        offers = both.select(F.explode(F.array(F.struct("entity", "low"), F.struct(F.col("label").alias("entity"), "low"))).alias("o")).select("o.*")
        best = cut(offers.groupBy("entity").agg(F.min("low").alias("label")), "offers")
        hop = best.select(F.col("entity").alias("label"), F.col("label").alias("next"))
        new = Table(best.join(hop, "label").select("entity", F.col("next").alias("label")), "labels")
        moved = new.df.join(known.withColumnRenamed("label", "was"), "entity").where("label <> was").limit(1).count()
        labels.drop()
        labels = new
        if not moved:
            break
    else:
        raise RuntimeError(f"not settled after {max_rounds} rounds")
    by_entity = links.join(labels.df, "entity", "left").select("record", F.coalesce("label", "entity").alias("group"))
    return by_entity.groupBy("record").agg(F.min("group").alias("group"))


def record_entities(df: DataFrame, record: str, entity: Column) -> DataFrame:
    """Distinct ``(record, entity)``; rows without a record or an entity tie nothing."""
    return df.select(df[record].alias("record"), entity.alias("entity")).where("record IS NOT NULL AND entity IS NOT NULL").distinct()


def assign(units: DataFrame, shares: Mapping[str, float], seed: str = "0", heavy: float = HEAVY) -> DataFrame:
    """``(unit, split)`` for ``units`` (unit, label, n): n records of a label in a unit, units being kept whole.

    Shares are scaled to sum to 1. A null label is a label of its own. A unit beyond ``heavy`` of all records goes where
    the squared deviation from the shares, summed over labels and splits, becomes least (the largest first; ties by unit,
    then the order of ``shares``); its labels below ``heavy`` of all records count as one there. The others are put in
    order by main label, all their labels with their counts, and a hash of unit and ``seed``; a unit's rank in that order
    times the golden ratio, of which only the fraction counts, tells its split, so that any run of units is dealt out
    evenly. Shares are those of the main label, less what the heavy units have taken. All labels are told apart, however many there are.
    At most 1 / heavy units, each with at most 1 / heavy labels, and one count per partition come to the driver, whatever the size.
    """
    names = list(shares)
    want = [shares[s] / sum(shares.values()) for s in names]
    units = units.withColumn("label", F.coalesce(F.col("label").cast("string"), F.lit("\0none")))
    units = cut(units.groupBy("unit", "label").agg(F.sum("n").alias("n")), "units")
    sums = cut(units.groupBy("label").agg(F.sum("n").alias("total")), "sums")
    total = sums.agg(F.sum("total")).first()[0] or 0
    sizes = units.groupBy("unit").agg(F.sum("n").alias("size"))
    big = cut(units.join(sizes.where(F.col("size") > F.lit(heavy * total)), "unit"), "heavy")
    often = sums.where(F.col("total") > F.lit(heavy * total))
    known = big.join(often, "label", "left").withColumn("label", F.when(F.col("total").isNotNull(), F.col("label")))
    hists: dict[tuple, dict] = {}
    for r in known.groupBy("unit", "size", "label").agg(F.sum("n").alias("n")).collect():
        hists.setdefault((r["unit"], r["size"]), {})[r["label"]] = r["n"]
    of = {r["label"]: r["total"] for r in often.collect()}
    of[None] = max(1, total - sum(of.values()))
    have = {(s, x): 0.0 for s in names for x in of}
    placed: list[tuple] = []
    for unit, _ in sorted(hists, key=lambda k: (-k[1], str(k[0]))):
        hist = hists[unit, _]
        cost = {}
        for s, w in zip(names, want):
            # what this unit changes of the summed squared deviations, each label's relative to its own size
            cost[s] = sum((((have[s, x] + n) - w * of[x]) ** 2 - (have[s, x] - w * of[x]) ** 2) / of[x] for x, n in hist.items())
        s = min(names, key=lambda s: cost[s])
        placed.append((unit, s))
        for x, n in hist.items():
            have[s, x] += n
    unit_type = units.schema["unit"].dataType.simpleString()
    heavy_df = units.sparkSession.createDataFrame(placed, f"unit {unit_type}, split string")
    # what is open of each label, as the shares at which each split ends
    taken = big.join(heavy_df, "unit").groupBy("label").agg(*[F.sum(F.when(F.col("split") == s, F.col("n")).otherwise(0)).alias(f"t{i}") for i, s in enumerate(names)])
    room = [F.greatest(F.lit(0.0), F.lit(w) * F.col("total") - F.coalesce(f"t{i}", F.lit(0))) for i, w in enumerate(want)]
    whole = sum(room[1:], room[0])
    ends = F.array(*[F.when(whole > 0, sum(room[1 : i + 1], room[0]) / whole).otherwise(F.lit(sum(want[: i + 1]))) for i in range(len(names))])
    edges = sums.join(taken, "label", "left").select(F.col("label").alias("main"), ends.alias("ends"))
    light = units.join(big.select("unit").distinct(), "unit", "left_anti").groupBy("unit").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "label"))).alias("labels")
    )
    light = light.withColumn("main", F.get("labels", 0)["label"]).withColumn("profile", F.to_json("labels"))
    light = light.select("unit", "main", "profile", F.xxhash64(F.lit(seed), F.col("unit").cast("string")).alias("lot"))
    light = global_rank(light, [F.col("main"), F.col("profile"), F.col("lot"), F.col("unit")]).join(edges, "main")
    at = F.col("rank") * F.lit(GOLDEN)
    at = at - F.floor(at)
    pick = F.lit(names[-1])
    for i in reversed(range(len(names) - 1)):
        pick = F.when(at < F.get("ends", i), F.lit(names[i])).otherwise(pick)
    return light.select("unit", pick.alias("split")).unionByName(heavy_df)
