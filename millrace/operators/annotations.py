"""Nested annotation and inference records as flat tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANNOTATION = (
    "id string, audio string, data struct<audio_url: string, audio: string>, "
    "annotations array<struct<result: array<struct<from_name: string, value: struct<choices: array<string>, text: array<string>>>>>>"
)
INFERENCE = (
    "sample_id string, audio_id string, audio_path string, predictions struct<instruments: array<string>, mood: array<string>, "
    "genre: array<string>, tempo: double, key: string, confidence: map<string, double>>"
)


def answer(result: Column, name: str, kind: str = "choices") -> Column:
    """The first value of the first result of that name, else an empty text."""
    found = F.get(F.filter(result, lambda r: r["from_name"] == name), 0)
    return F.coalesce(F.get(found["value"][kind], 0), F.lit(""))


def flatten(df: DataFrame, choices: Sequence[str], texts: Sequence[str] = ()) -> DataFrame:
    """``(id, audio, choices..., texts..., raw)`` of records like ``ANNOTATION``: the first annotation's answers, by name.

    The audio is ``audio``, else ``data.audio_url``, else ``data.audio``. A record without annotations has empty answers.
    """
    r = F.coalesce(F.get("annotations", 0)["result"], F.array())
    result = F.get("annotations", 0)["result"]
    return df.select(
        "id", F.coalesce("audio", "data.audio_url", "data.audio").alias("audio"),
        *[answer(result, c).alias(c) for c in choices], *[answer(result, t, "text").alias(t) for t in texts], F.to_json(r).alias("raw"),
    )


def tasks(df: DataFrame, url: str = "") -> DataFrame:
    """Labelling tasks of inference records with ``item_id``: lists joined by ", ", missing ones empty."""
    p = lambda f: F.array_join(F.coalesce(F.col(f"predictions.{f}"), F.array().cast("array<string>")), ", ")
    return df.select(
        F.col("item_id").alias("id"), F.concat(F.lit(url), F.coalesce("audio_path", F.lit(""))).alias("audio"),
        p("instruments").alias("instruments"), p("mood").alias("mood"), p("genre").alias("genre"), F.col("predictions.tempo").alias("tempo"), F.col("predictions.key").alias("key"),
    )
