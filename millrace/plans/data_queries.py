"""Queries of the general training-data problems: copies compared, intervals merged, packed fields split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.strings import folded
from millrace.operators import diff, intervals, packed
from millrace.plans.tag_queries import PACKED_SQL
from millrace.sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    cols = ("audio_id", "sha256", "file_relative_path", "file_bytes", "import_timestamp")
    return diff.diff_copies(
        table(spark, d, "raw_audio_checksums", *cols),
        table(spark, d, "storage_checksums", *cols),
        key="audio_id",
        fields=("sha256", "file_relative_path", "file_bytes"),
        version="import_timestamp",
        normalise={"sha256": folded, "file_relative_path": diff.styled_path},
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "chunk_manifest_test", "audio_id", "start_time", "end_time")
    return intervals.periods_and_gaps(chunks, "audio_id", intervals.to_ms(F.col("start_time")), intervals.to_ms(F.col("end_time")))


PACKED = (
    ("dataset_joined", "track_id", "tags", packed.TAGS),
    ("language_cache", "audio_path", "lang_top5", packed.LANGS),
    ("yamnet_output", "track_id", "yamnet_top_tags", packed.EVENTS),
)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        packed.unpack(table(spark, d, t, k, c), F.col(k), F.col(c), g).select(F.lit(t).alias("table_name"), "record_key", "pos", "item")
        for t, k, c, g in PACKED
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).distinct()


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found}

ORACLE = {
    "p2_found": r"""
WITH a AS (SELECT audio_id k, arg_max({'s': sha256, 'p': file_relative_path, 'b': file_bytes}, import_timestamp) v
           FROM raw_audio_checksums WHERE audio_id IS NOT NULL GROUP BY 1),
b AS (SELECT audio_id k, arg_max({'s': sha256, 'p': file_relative_path, 'b': file_bytes}, import_timestamp) v
      FROM storage_checksums WHERE audio_id IS NOT NULL GROUP BY 1),
j AS (SELECT coalesce(a.k, b.k) audio_id, a.k IS NULL na, b.k IS NULL nb,
  lower(regexp_replace(a.v.s, '^\s+|\s+$', '', 'g')) s1, lower(regexp_replace(b.v.s, '^\s+|\s+$', '', 'g')) s2,
  regexp_replace(regexp_replace(regexp_replace(a.v.p, '^\s+|\s+$', '', 'g'), '[/\\]+', '/', 'g'), '^(\./)+', '') p1,
  regexp_replace(regexp_replace(regexp_replace(b.v.p, '^\s+|\s+$', '', 'g'), '[/\\]+', '/', 'g'), '^(\./)+', '') p2,
  a.v.b b1, b.v.b b2 FROM a FULL JOIN b ON a.k = b.k)
SELECT audio_id, 'missing_in_copy' AS diff FROM j WHERE nb
UNION ALL SELECT audio_id, 'missing_in_baseline' FROM j WHERE na
UNION ALL SELECT audio_id, 'sha256' FROM j WHERE NOT na AND NOT nb AND s1 IS DISTINCT FROM s2
UNION ALL SELECT audio_id, 'file_relative_path' FROM j WHERE NOT na AND NOT nb AND p1 IS DISTINCT FROM p2
UNION ALL SELECT audio_id, 'file_bytes' FROM j WHERE NOT na AND NOT nb AND b1 IS DISTINCT FROM b2""",
    "p3_found": """
WITH i AS (SELECT audio_id, CAST(round(start_time * 1000) AS BIGINT) s, CAST(round(end_time * 1000) AS BIGINT) e
           FROM chunk_manifest_test WHERE NOT isnan(start_time) AND NOT isnan(end_time)),
o AS (SELECT *, max(e) OVER (PARTITION BY audio_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) pe FROM i WHERE e > s),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (PARTITION BY audio_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) n FROM o),
p AS (SELECT audio_id, n, min(s) s, max(e) e FROM g GROUP BY 1, 2)
SELECT audio_id, 'period' AS kind, s AS start_ms, e AS end_ms FROM p
UNION ALL SELECT * FROM (SELECT audio_id, 'gap', e, lead(s) OVER (PARTITION BY audio_id ORDER BY s) ns FROM p) WHERE ns IS NOT NULL""",
    "p4_found": PACKED_SQL,
}
