"""Continuous periods and gaps of overlapping intervals, by a sweep line split over time buckets.

Boundaries become plus and minus events. An entity's time is cut into buckets of a fixed width, so that neither a hot
entity nor a long recording ever forms one task's group: windows run over (entity, bucket), which holds at most as many
distinct times as the bucket is wide, and over an entity's buckets, which are fewer than its events and at most its
span divided by the width. Active counts and the next boundary are carried from bucket to bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_MS = 600_000


def to_ms(seconds: Column) -> Column:
    """Seconds as whole milliseconds; null, NaN and what no bigint can hold give null."""
    return F.when(~F.isnan(seconds), F.round(seconds * 1000).try_cast("bigint"))


def periods_and_gaps(df: DataFrame, key: str, start: Column, end: Column, width: int = BUCKET_MS) -> DataFrame:
    """``(key, kind, start_ms, end_ms)`` with kind ``period`` or ``gap``, from whole numbers ``start`` and ``end``.

    Intervals with a null time, or that don't end after their start, take no part; those that touch are one period.
    A null key is an entity of its own. Repeated intervals change nothing; an empty table gives no rows.
    """
    iv = df.select(df[key].alias("k"), start.alias("s"), end.alias("e")).where("e > s")
    ends = F.array(F.struct(F.col("s").alias("t"), F.lit(1).alias("d")), F.struct(F.col("e").alias("t"), F.lit(-1).alias("d")))
    ev = iv.select("k", F.explode(ends).alias("x")).select("k", F.col("x.t").alias("t"), F.col("x.d").alias("d"))
    ev = ev.withColumn("b", F.floor(F.col("t") / F.lit(width)).cast("bigint"))
    # summed by time before and after a shuffle by time, so that repeats of one stretch don't meet in one task as raw events
    ev = ev.groupBy("k", "b", "t").agg(F.sum("d").alias("d")).where("d <> 0").repartition("k", "b")

    by_time = Window.partitionBy("k", "b").orderBy("t")
    nets = ev.groupBy("k", "b").agg(F.sum("d").alias("net"))
    before = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carry = nets.select(F.col("k").alias("ck"), F.col("b").alias("cb"), F.coalesce(F.sum("net").over(before), F.lit(0)).alias("carry"))
    upto = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ev = ev.withColumn("run", F.sum("d").over(upto)).join(carry, F.expr("k <=> ck AND b = cb"))
    ev = ev.select("k", "b", "t", "d", (F.col("run") + F.col("carry")).alias("n"))

    # a boundary is where the count leaves or reaches nought
    edge = ev.where((F.col("n") == 0) | (F.col("n") == F.col("d"))).select("k", "b", "t", (F.col("n") > 0).alias("opens"))
    edge = edge.withColumn("nxt", F.lead("t").over(by_time))
    firsts = edge.groupBy("k", "b").agg(F.min("t").alias("first"))
    after = Window.partitionBy("k").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select(F.col("k").alias("ck"), F.col("b").alias("cb"), F.min("first").over(after).alias("later"))
    return (
        edge.join(firsts, F.expr("k <=> ck AND b = cb"))
        .select(
            F.col("k").alias(key),
            F.when(F.col("opens"), "period").otherwise("gap").alias("kind"),
            F.col("t").alias("start_ms"),
            F.coalesce("nxt", "later").alias("end_ms"),
        )
        .where("end_ms IS NOT NULL")
    )
