"""Vector arithmetic on array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOOR = 1e-10


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """``v`` divided by its length, which counts as 1e-10 at least."""
    n = F.greatest(norm(v), F.lit(FLOOR))
    return F.transform(v, lambda x: x / n)


def cosine(a: Column, b: Column) -> Column:
    """Null where either has no length."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def argmax(v: Column) -> Column:
    """The place (from 0) of the first greatest element."""
    return F.array_position(v, F.array_max(v)).cast("int") - 1


def decibels(p: Column, q: Column, factor: float = 10.0) -> Column:
    """factor * log10(p / q); infinite where q isn't above 0."""
    return F.when(q > 0, F.lit(factor) * F.log10(p / q)).otherwise(F.lit(float("inf")))


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def peak_gain(peak_db: Column, ceiling_db: float) -> Column:
    """The linear gain that brings a peak down to a ceiling; 1 if it is below."""
    return F.when(peak_db > ceiling_db, F.pow(F.lit(10.0), (F.lit(ceiling_db) - peak_db) / 20)).otherwise(F.lit(1.0))
