"""Ids and the paths made from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: Crockford's alphabet, 26 places
ULID = r"^[0-9A-HJKMNP-TV-Z]{26}$"


def valid_id(c: Column) -> Column:
    return F.coalesce(F.upper(c).rlike(ULID), F.lit(False))


def sharded_path(base: str, audio_id: Column, extension: Column) -> Column:
    """``base/hh/hh/md5_ID.ext``: the id in upper case, sharded by the first bytes of its MD5."""
    up = F.upper(audio_id)
    h = F.md5(up)
    return F.concat(F.lit(base + "/"), F.substring(h, 1, 2), F.lit("/"), F.substring(h, 3, 2), F.lit("/"), h, F.lit("_"), up, F.lit("."), extension)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def stem(path: Column) -> Column:
    """The file name without its last extension."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def id_in_name(path: Column) -> Column:
    """What follows the first underscore of the stem, in upper case; null without one."""
    found = F.regexp_extract(stem(path), r"^[^_]*_(.*)$", 1)
    return F.when(found != "", F.upper(found))
