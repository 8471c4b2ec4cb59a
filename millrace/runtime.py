"""Things every operator needs from the running session: the shared folder, lineage cuts, shipped code."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it in ``spark.checkpoint.dir``.

    Only in local mode, where the session names none (tests, a laptop), a temporary folder is made and set.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="millrace-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


class Table:
    """A DataFrame written to the shared folder: its lineage is cut and it survives the loss of executors.

    ``count`` is a condition; ``counted`` is then the number of rows for which it holds, counted while they are written.
    """

    def __init__(self, df: DataFrame, name: str = "t", count: Column | None = None):
        spark = df.sparkSession
        self.path = f"{shared_dir(spark).rstrip('/')}/millrace-{name}-{uuid.uuid4().hex}"
        if count is None:
            df.write.parquet(self.path)
        else:
            seen = Observation()
            df.observe(seen, F.count_if(count).alias("n")).write.parquet(self.path)
            self.counted = seen.get["n"]
        self._jpath = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._jpath.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.deleteOnExit(self._jpath)
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        self._fs.delete(self._jpath, True)


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """``df`` written to the shared folder and read again; the files go when the session ends."""
    return Table(df, name).df


def scratch(spark: SparkSession, name: str) -> str:
    """The path of a new folder in the shared one; it goes when the session ends."""
    path = f"{shared_dir(spark).rstrip('/')}/millrace-{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return path


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for work that is heavy per row on a table of few files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Give executors this package, wherever their Python path points. Once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_millrace_shipped", False):
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="millrace-code-")) / "millrace_code.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(out))
    sc._millrace_shipped = True
