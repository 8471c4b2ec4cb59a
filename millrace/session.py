"""Session factory with the settings that the operators are tuned under."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(app: str = "millrace", cores: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the submitted session is used instead."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
