"""Counts, summaries, histograms and funnels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)`` without nulls."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n, mean, std, min, max)`` with the sample deviation, without nulls and NaN, in one pass."""
    x = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    stats = [F.struct(F.lit(c).alias("column"), F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")) for c, v in x.items()]
    return df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int = 30) -> DataFrame:
    """``(bin, n)``: bins 1 to ``bins`` between the bounds, the upper one in the last; 0 and bins + 1 lie outside."""
    x = F.col(column).cast("double")
    b = F.when(x == high, F.lit(bins)).otherwise(F.width_bucket(x, F.lit(float(low)), F.lit(float(high)), F.lit(bins)))
    return df.where(x.isNotNull() & ~F.isnan(x)).groupBy(b.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


def box(df: DataFrame, column: str, by: str) -> DataFrame:
    """``(by, n, q1, median, q3)``, exact, without nulls and NaN."""
    x = F.col(column).cast("double")
    q = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.where(x.isNotNull() & ~F.isnan(x)).groupBy(by).agg(F.count("*").alias("n"), q.alias("q")).select(by, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))


def categorical(df: DataFrame, below: int = 20) -> DataFrame:
    """``(column, n_distinct, is_categorical)`` of the string columns, counted exactly in one pass."""
    names = [c for c, t in df.dtypes if t == "string"]
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in names])
    long = df.select(F.explode(items).alias("x")).select("x.*").distinct()
    return long.groupBy("column").agg(F.count("v").alias("n_distinct")).withColumn("is_categorical", F.col("n_distinct") < below)


def funnel(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``(ord, stage, n, retention)``: rows of each stage, and their share of the first's in percent."""
    out = None
    for i, (name, df) in enumerate(stages):
        one = df.agg(F.lit(i).alias("ord"), F.lit(name).alias("stage"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    first = F.first("n").over(Window.orderBy("ord"))  # one row per stage
    return out.withColumn("retention", F.when(first > 0, F.round(F.col("n") / first * 100, 2)).otherwise(F.lit(0.0)))


def totals(df: DataFrame, size: str) -> DataFrame:
    """``(files, bytes)``."""
    return df.agg(F.count("*").alias("files"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))


def id_totals(df: DataFrame, by: str, key: str) -> DataFrame:
    """``(by, n, n_distinct, repeated)``: rows, distinct keys and rows beyond the first of their key."""
    per = df.groupBy(by, key).agg(F.count("*").alias("_n"))
    n, k = F.sum("_n"), F.count(key)
    return per.groupBy(by).agg(n.alias("n"), k.alias("n_distinct"), F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("_n") - 1)), F.lit(0)).alias("repeated"))


def risk_report(df: DataFrame, columns: Sequence[str], threshold: float = 0.5, **tables) -> DataFrame:
    """Adds ``max_risk``, ``matches``, ``unsafe_columns`` ("a; b"), ``risk_level`` and ``is_safe`` over several text columns.

    Columns that the table lacks and null texts have no risk. ``tables`` are ``keywords`` and ``patterns`` of ``text.safety``.
    """
    there = [c for c in columns if c in df.columns]
    found = {c: text.safety(F.col(c).cast("string"), threshold=threshold, **tables) for c in there}
    df = df.withColumns({f"_s{i}": s for i, (s, _, _, _) in enumerate(found.values())}).withColumns({f"_n{i}": n for i, (_, n, _, _) in enumerate(found.values())})
    most = F.greatest(F.lit(0.0), F.lit(0.0), *[F.col(f"_s{i}") for i in range(len(there))])
    unsafe = F.concat_ws("; ", *[F.when(F.col(f"_s{i}") >= threshold, F.lit(c)) for i, c in enumerate(there)])
    matches = F.lit(0)
    for i in range(len(there)):
        matches = matches + F.col(f"_n{i}")
    df = df.withColumn("max_risk", most).withColumn("matches", matches).withColumn("unsafe_columns", unsafe)
    df = df.withColumn("risk_level", text.risk_level(F.col("max_risk"))).withColumn("is_safe", F.col("max_risk") < threshold)
    return df.drop(*[f"_s{i}" for i in range(len(there))], *[f"_n{i}" for i in range(len(there))])


def redaction_report(df: DataFrame, columns: Sequence[str], kinds: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the columns redacted, ``<column>_removed`` and ``<column>_types``, ``total_removed`` and ``all_types``.

    all_types has each kind once, with its count over all columns.
    """
    done: dict[str, list[str]] = {}
    for c in columns:
        df, done[c] = text.redact(df, c, kinds, prefix=f"_n_{c}_")
    per = {c: {k: F.col(f"_n_{c}_{k}") for k in names} for c, names in done.items()}
    names = done[columns[0]] if columns else []
    df = df.withColumns({f"{c}_removed": text.total(n) for c, n in per.items()}).withColumns({f"{c}_types": text.type_list(n) for c, n in per.items()})
    df = df.withColumn("total_removed", text.total({c: F.col(f"{c}_removed") for c in columns}))
    df = df.withColumn("all_types", text.type_list({k: text.total({c: per[c][k] for c in columns}) for k in names}))
    return df.drop(*[f"_n_{c}_{k}" for c, ks in done.items() for k in ks])


def tallies(df: DataFrame, status: Column, good: Sequence[str], bad: Sequence[str]) -> DataFrame:
    """``(total, success, failed, skipped)``: what is neither good nor bad, nulls too, is skipped."""
    yes, no = F.coalesce(status.isin(*good), F.lit(False)), F.coalesce(status.isin(*bad), F.lit(False))
    return df.agg(F.count("*").alias("total"), F.count_if(yes).alias("success"), F.count_if(no).alias("failed"), F.count_if(~yes & ~no).alias("skipped"))


def verdicts(df: DataFrame, passed: Column, repaired: Column) -> DataFrame:
    """``(total, passed, failed, repaired)`` of a batch."""
    ok = F.coalesce(passed, F.lit(False))
    return df.agg(F.count("*").alias("total"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed"), F.count_if(F.coalesce(repaired, F.lit(False))).alias("repaired"))


def serialised(df: DataFrame, places: Mapping[str, int], lists: Mapping[str, int | None] = {}) -> DataFrame:
    """Numbers rounded to their places (halves to even, as the exact binary value has them), lists as "a; b", cut to a number of entries.

    The cut is part of a report's form; the table itself keeps all entries. NaN and infinities stay.
    """
    def rounded(c: str, n: int) -> Column:
        x = F.col(c).cast("double")
        return F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(F.bround(x.cast("decimal(38,18)"), n).cast("double"))

    cols = {c: rounded(c, n) for c, n in places.items()}
    cols |= {c: F.array_join(F.slice(F.col(c), 1, n) if n else F.col(c), "; ") for c, n in lists.items()}
    return df.withColumns(cols)


def joined(lists: Column, separator: str = ", ", most: int | None = None) -> Column:
    """A list as text; a null list is empty."""
    x = F.coalesce(lists, F.array().cast("array<string>"))
    return F.array_join(F.slice(x, 1, most) if most else x, separator)
