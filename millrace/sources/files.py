"""File sources and sinks: CSV, ragged TSV, JSON lines, directories of JSON, file lists, embeddings, inventories."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.paths import stem
from millrace.functions.strings import stripped
from millrace.functions.vocabulary import Vocabulary, parse_dictionary

# fixed values: columns of an embedding table that are no dimensions, and names of its id
METADATA = ("track_id", "audio_id", "id", "filename", "duration_s", "sample_rate", "n_channels", "n_samples", "dominant_note", "dominant_note_name", "bpm", "n_beats")
ID_NAMES = ("track_id", "audio_id", "id", "filename")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, missing_ok: bool = False) -> DataFrame:
    """A CSV file with a header under a given schema; a file that isn't there is an error, or an empty table."""
    if missing_ok and not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def first_existing(spark: SparkSession, folder: str, names: Sequence[str]) -> str | None:
    """The first of the candidate files that is there."""
    return next((p for n in names if _exists(spark, p := f"{folder.rstrip('/')}/{n}")), None)


def active_manifest(df: DataFrame) -> DataFrame:
    """The active rows, where the table tells a status; else all."""
    return df.where(F.col("status") == "active") if "status" in df.columns else df


def read_ragged_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``(TRACK_ID, ARTIST_ID, ALBUM_ID, PATH, DURATION, TAGS)``: five fields, and any more joined by blanks into TAGS.

    A first line that begins with TRACK_ID is the header; a duration that is no number is null; lines with fewer than five fields are left out.
    """
    f = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("TRACK_ID\t") & (F.size(f) >= 5))
    return lines.select(
        *[f[i].alias(n) for i, n in enumerate(("TRACK_ID", "ARTIST_ID", "ALBUM_ID", "PATH"))],
        f[4].try_cast("double").alias("DURATION"), F.array_join(F.slice(f, 6, F.greatest(F.lit(1), F.size(f))), " ").alias("TAGS"),
    )


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON lines file; blank and malformed lines are left out."""
    rows = spark.read.text(path).where(F.trim("value") != "")
    rows = rows.withColumn("bad", F.try_parse_json("value").isNull()).where("NOT bad")
    return rows.select(F.from_json("value", schema).alias("r")).where("r IS NOT NULL").select("r.*")


def read_json_documents(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """One record per JSON file of a folder, with ``item_id``: sample_id, else audio_id, else the file's stem. Broken files are left out."""
    broken = "_broken"
    df = spark.read.schema(f"{schema}, {broken} string").option("multiLine", True).option("columnNameOfCorruptRecord", broken).option("pathGlobFilter", "*.json").json(folder)
    df = df.withColumn("_name", F.col("_metadata.file_name")).where(F.col(broken).isNull()).drop(broken)
    known = [F.col(c) for c in ("sample_id", "audio_id") if c in df.columns]
    return df.withColumn("item_id", F.coalesce(*known, stem(F.col("_name")))).drop("_name")


def read_file_list(spark: SparkSession, path: str) -> DataFrame:
    """``(item_id, path)`` of lines "id,path" or "path"; blank lines and those that begin with # are left out."""
    line = stripped(F.col("value"))
    rows = spark.read.text(path).select(line.alias("l")).where("l <> '' AND NOT startswith(l, '#')")
    two = F.contains("l", F.lit(","))
    p = F.when(two, stripped(F.regexp_extract("l", r"^[^,]*,(.*)$", 1))).otherwise(F.col("l"))
    return rows.select(F.when(two, stripped(F.substring_index("l", ",", 1))).otherwise(stem(p)).alias("item_id"), p.alias("path"))


def embeddings(df: DataFrame) -> DataFrame:
    """``(id, vector)`` of a wide table: the id by name, else the first column; dimensions are dim_* or else all other numbers.

    Null and NaN become 0.
    """
    key = next((c for c in ID_NAMES if c in df.columns), df.columns[0])
    numeric = [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint", "smallint", "tinyint") or t.startswith("decimal")]
    dims = sorted((c for c in numeric if c.startswith("dim_")), key=lambda c: (len(c), c)) or [c for c in numeric if c not in METADATA and c != key]
    return df.select(F.col(key).alias("id"), F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in dims]).alias("vector"))


def input_list(df: DataFrame) -> DataFrame:
    """``(item_id, path)`` of a table: its columns track_id and path, or paths in a column named path, else in its first; ids are then stems."""
    path = "path" if "path" in df.columns else df.columns[0]
    own = F.col("track_id") if "track_id" in df.columns and path == "path" else F.lit(None).cast("string")
    return df.where(F.col(path).isNotNull()).select(F.coalesce(own, stem(F.col(path))).alias("item_id"), F.col(path).alias("path"))


def read_dictionary(spark: SparkSession, path: str) -> Vocabulary:
    """A tag vocabulary from a JSON document; a small file, read on the driver."""
    return parse_dictionary("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def inventory(spark: SparkSession, folder: str, checksum: bool = True, skip: str = ".done", extensions: Sequence[str] | None = None, md5: bool = False) -> DataFrame:
    """``(path, size, sha256)`` of the files below a folder, marker files left out, with ``extensions`` only those (in any letter case).

    Contents are only read for checksums.
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).where(~F.col("path").endswith(skip))
    if extensions is not None:
        df = df.where(F.lower(F.regexp_extract("path", r"\.([^./\\\\]*)$", 1)).isin(*[e.lower().lstrip(".") for e in extensions]))
    sums = [F.sha2("content", 256).alias("sha256")] * checksum + [F.md5("content").alias("md5")] * md5
    return df.select("path", F.col("length").alias("size"), *sums)


def write(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Written by suffix: .csv with a header, .json as lines, .parquet; any other name gets .parquet. Returns the path."""
    kind = os.path.splitext(path)[1]
    if kind == ".csv":
        df.write.mode(mode).option("header", True).csv(path)
    elif kind in (".json", ".jsonl"):
        df.write.mode(mode).json(path)
    else:
        path = path if kind == ".parquet" else path + ".parquet"
        df.write.mode(mode).parquet(path)
    return path
