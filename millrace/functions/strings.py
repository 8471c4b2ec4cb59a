"""String normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(c: Column) -> Column:
    """Without white space of any kind around it."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def folded(c: Column) -> Column:
    """Stripped, in lower case."""
    return F.lower(stripped(c))


def plain_hash(c: Column) -> Column:
    """A hash without letter case, surrounding white space and a leading "sha256:"."""
    return stripped(F.regexp_replace(folded(c), r"^sha256:", ""))
