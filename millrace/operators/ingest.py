"""Records of new files: ids, checksum and manifest rows, batches, media information."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.paths import base_name, id_in_name, valid_id

#: fixed value: Crockford's alphabet
ALPHABET = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def ulid(millis: Column, entropy: Column) -> Column:
    """A 26-place id: 48 bits of time, then 80 bits of the SHA-256 of ``entropy``, so that equal input has an equal id.

    Null for a null or negative time.
    """
    def place(x: Column) -> Column:
        return F.substring(F.lit(ALPHABET), (x + 1).cast("int"), F.lit(1))

    time = [place(F.shiftright(millis, 5 * i).bitwiseAND(31)) for i in reversed(range(10))]
    h = F.sha2(entropy.cast("string"), 256)
    # 20 hex digits: four groups of 5, each 4 places of 5 bits
    groups = [F.conv(F.substring(h, 1 + 5 * g, 5), 16, 10).cast("bigint") for g in range(4)]
    rest = [place(F.shiftright(x, 5 * i).bitwiseAND(31)) for x in groups for i in reversed(range(4))]
    return F.when(millis >= 0, F.concat(*time, *rest))


def records(files: DataFrame, path: str, size: str, checksum: str, imported: Column) -> tuple[DataFrame, DataFrame]:
    """(checksum rows, manifest rows) of an inventory of files; files whose name holds no valid id are left out of both."""
    rows = files.withColumn("audio_id", id_in_name(F.col(path))).where(valid_id(F.col("audio_id")))
    rows = rows.select("audio_id", F.col(path).alias("file_relative_path"), base_name(F.col(path)).alias("original_filename"), F.col(checksum).alias("sha256"), F.col(size).alias("file_bytes"), imported.alias("import_timestamp"))
    extension = F.lower(F.regexp_extract("original_filename", r"\.([^.]*)$", 1))
    return rows, rows.withColumn("format", extension).withColumn("status", F.lit("active"))


def manifest_items(df: DataFrame, key: str, path: str, duration: str) -> DataFrame:
    """``(key, path, duration)`` of the rows with an id and a path that aren't empty; an absent duration is 0."""
    some = lambda c: F.col(c).isNotNull() & (F.trim(c) != "")
    return df.where(some(key) & some(path)).select(key, path, F.coalesce(F.nanvl(F.col(duration).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(duration))


def items_or_folder(items: DataFrame, folder: DataFrame, like: Sequence[str]) -> DataFrame:
    """``items``, or what was found in a folder if there are none."""
    return items if items.limit(1).count() else folder.select(*like)


def synthesised(df: DataFrame, track: str, duration: str, base: str, extension: str, constants: Mapping[str, object]) -> DataFrame:
    """A manifest from joined features: ids and paths by the track, and constants for what the features don't tell."""
    name = F.concat(F.col(track), F.lit(f".{extension}"))
    return df.select(
        F.col(track).alias("audio_id"), name.alias("original_filename"), F.concat(F.lit(base.rstrip("/") + "/"), name).alias("file_relative_path"), F.lit("active").alias("status"),
        F.col(duration).alias("duration_seconds"), *[F.lit(v).alias(k) for k, v in constants.items()],
    )


def batch(ids: DataFrame, manifest: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the manifest, ids that it lacks) of a batch of ids; an id given or held twice counts once (the least row)."""
    wanted = ids.select(key).where(F.col(key).isNotNull()).distinct()
    there = manifest.join(wanted, key, "left_semi").groupBy(F.col(key).alias("_k")).agg(F.min(F.struct(*manifest.columns)).alias("r")).select("r.*")
    return there, wanted.join(manifest.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_anti")


def denoise_status(df: DataFrame, path: str, done: DataFrame, failed: DataFrame, dry_run: bool = False) -> DataFrame:
    """``(path, audio_id, status)`` of candidates: success, failed (no id, or listed as failed), dry_run or pending."""
    rows = df.select(path, id_in_name(F.col(path)).alias("audio_id"))
    d, f = done.select(F.col("audio_id").alias("_d")).distinct(), failed.select(F.col("audio_id").alias("_f")).distinct()
    j = rows.join(d, F.col("audio_id") == F.col("_d"), "left").join(f, F.col("audio_id") == F.col("_f"), "left")
    status = F.when(F.col("audio_id").isNull() | F.col("_f").isNotNull(), "failed").when(F.lit(dry_run), "dry_run").when(F.col("_d").isNotNull(), "success").otherwise("pending")
    return j.select(path, "audio_id", status.alias("status"))


def wave_header(content: bytes | None) -> tuple:
    """(sample rate, channels, bits, seconds) of a RIFF wave file; all null where it is broken or another format."""
    none = (None, None, None, None)
    if content is None or len(content) < 12 or content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        return none
    at, form = 12, None
    while at + 8 <= len(content):
        name, size = content[at : at + 4], struct.unpack("<I", content[at + 4 : at + 8])[0]
        if name == b"fmt " and at + 24 <= len(content):
            form = struct.unpack("<HHIIHH", content[at + 8 : at + 24])
        elif name == b"data" and form and form[3]:
            return form[2], form[1], form[5], size / form[3]
        at += 8 + size + size % 2
    return none


def probe(df: DataFrame, key: str, content: str) -> DataFrame:
    """``(key, sample_rate, channels, bits, seconds, corrupted)`` of wave files by their headers."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [wave_header(bytes(c) if c is not None else None) for c in b[content]]
            out = pd.DataFrame(got, columns=["sample_rate", "channels", "bits", "seconds"], dtype=object)
            out.insert(0, key, b[key].to_numpy())
            out["corrupted"] = [g[0] is None for g in got]
            yield out

    return df.select(key, content).mapInPandas(run, f"`{key}` {kind}, sample_rate int, channels int, bits int, seconds double, corrupted boolean")
