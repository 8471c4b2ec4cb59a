"""Named Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, data_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan ``{data_dir}/{name}.parquet``, reading only ``columns`` if given (a column twice is read once)."""
    df = spark.read.parquet(f"{data_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
