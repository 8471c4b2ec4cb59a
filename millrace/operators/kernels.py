"""Slots for models and decoders, and a cache of what they gave."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _tried(kernel: Callable, b: pd.DataFrame, fail_open: bool) -> list[tuple[pd.DataFrame | None, pd.DataFrame, str | None]]:
    """(output, rows, error) of a batch, or, where the kernel fails on it, of each of its rows."""
    try:
        return [(kernel(b).reset_index(drop=True), b, None)]
    except Exception as e:
        if not fail_open:
            raise
        if len(b) == 1:
            return [(None, b, f"{type(e).__name__}: {e}")]
    return [t for i in range(len(b)) for t in _tried(kernel, b.iloc[i : i + 1], True)]


def _loaded(loads: Sequence[Callable]) -> Callable:
    """The first kernel of a chain that loads."""
    for i, load in enumerate(loads):
        try:
            return load()
        except Exception:
            if i == len(loads) - 1:
                raise


def apply_kernel(df: DataFrame, load: Callable | Sequence[Callable], schema: str, keep: list[str], fail_open: bool = True) -> DataFrame:
    """``keep``, the kernel's columns (``schema``) and ``error`` per row, batch by batch; ``load`` runs once per task.

    ``load`` gives a kernel, or is a chain of which the first that loads is taken. The kernel gives one row per row of its
    batch, in order. A batch that it fails on is tried row by row; a row that it fails on has nulls and the error's text,
    or, unless ``fail_open``, ends the job. An empty table loads nothing and gives no rows.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    shape = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [schema, "error string"])
    names = df.sparkSession.createDataFrame([], schema).columns
    loads = list(load) if isinstance(load, Sequence) else [load]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kernel = None
        for b in batches:
            kernel = kernel or _loaded(loads)
            for out, part, error in _tried(kernel, b, fail_open):
                out = pd.DataFrame({c: [None] for c in names}, dtype=object) if out is None else out[names]
                yield pd.concat([part[keep].reset_index(drop=True), out], axis=1).assign(error=error)

    return df.mapInPandas(run, shape)


def expand_kernel(df: DataFrame, load: Callable | Sequence[Callable], schema: str, keep: list[str], fail_open: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, failed): the kernel gives any number of rows per row, as frames of a recording, each with ``row``, the number of its
    row in the batch; failed holds ``keep`` and ``error`` of the rows that it fails on.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    own = [f"`{c}` {kinds[c]}" for c in keep]
    names = df.sparkSession.createDataFrame([], schema).columns
    loads = list(load) if isinstance(load, Sequence) else [load]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kernel = None
        for b in batches:
            kernel = kernel or _loaded(loads)
            for out, part, error in _tried(kernel, b, fail_open):
                if out is None:
                    out = pd.DataFrame({c: [None] for c in names}, dtype=object).assign(row=0)
                head = part[keep].iloc[out["row"].to_numpy()].reset_index(drop=True)
                yield pd.concat([head, out[names].reset_index(drop=True)], axis=1).assign(error=error)

    every = df.mapInPandas(run, ", ".join([*own, schema, "error string"]))
    return every.where("error IS NULL").drop("error"), every.where("error IS NOT NULL").select(*keep, "error")


def remembered(df: DataFrame, cache: DataFrame, key: str, compute: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(results, new): cached results for the keys that ``cache`` has, computed ones for the rest, which are ``new``.

    ``compute`` gives the cache's columns; it sees each missing key's rows only. Rows with a null key are always computed.
    """
    there = df.select(F.col(key).alias("_k")).distinct()
    old = cache.join(there, F.col(key) == F.col("_k"), "left_semi")
    new = compute(df.join(cache.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_anti")).select(*cache.columns)
    return old.unionByName(new), new
