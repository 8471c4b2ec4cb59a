"""Differences between two copies of a table: missing rows and differing fields.

Sides are tagged and united, grouped once by key, one struct kept per side, and the structs compared field by field
by a generated higher-order expression. One shuffle, no join; a key with many versions is folded before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.strings import stripped

MISSING_IN_COPY, MISSING_IN_BASELINE = "missing_in_copy", "missing_in_baseline"


def styled_path(c: Column) -> Column:
    """A path without surrounding white space, leading "./", repeated slashes and backslashes."""
    p = F.regexp_replace(stripped(c), r"[/\\]+", "/")
    return F.regexp_replace(p, r"^(\./)+", "")


def diff_copies(
    baseline: DataFrame,
    copy: DataFrame,
    key: str,
    fields: Sequence[str],
    version: str | None = None,
    normalise: Mapping[str, object] | None = None,
) -> DataFrame:
    """``(key, diff)``: one row per key missing on a side and per field that differs.

    ``version`` orders several rows of a key, the greatest counts (null is oldest; ties fall to the greatest values, so
    that the result doesn't depend on row order). ``normalise`` maps fields to Column functions applied before comparing.
    Null differs from any value and equals null. Rows with a null key identify nothing and are left out. Both tables
    empty give no rows; other columns of either table, of whatever names, are not read.
    """
    normalise = normalise or {}

    def side(df: DataFrame, tag: int) -> DataFrame:
        vals = [normalise.get(f, lambda c: c)(df[f]).alias(f"f{i}") for i, f in enumerate(fields)]
        ver = (df[version] if version else F.lit(0)).alias("v")
        return df.where(df[key].isNotNull()).select(df[key].alias("k"), F.lit(tag).alias("side"), F.struct(ver, *vals).alias("s"))

    # the greatest struct is the latest version: max() folds on the map side, and again after the shuffle
    one = side(baseline, 0).unionByName(side(copy, 1)).groupBy("k").agg(
        F.max(F.when(F.col("side") == 0, F.col("s"))).alias("a"),
        F.max(F.when(F.col("side") == 1, F.col("s"))).alias("b"),
    )
    # compared by one generated expression: an array of (differs, name), filtered to names
    tests = ", ".join(f"named_struct('d', NOT (a.f{i} <=> b.f{i}), 'n', '{f}')" for i, f in enumerate(fields))
    found = (
        f"CASE WHEN b IS NULL THEN array('{MISSING_IN_COPY}') WHEN a IS NULL THEN array('{MISSING_IN_BASELINE}') "
        f"ELSE transform(filter(array({tests}), x -> x.d), x -> x.n) END"
    )
    return one.select(F.col("k").alias(key), F.explode(F.expr(found)).alias("diff"))
