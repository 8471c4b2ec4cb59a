"""Stages chained into one lazy plan, with what each lets through and rejects, and the lineage of a run."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.reports import funnel


@dataclass
class Result:
    """What a stage gives: the rows that go on, and the rejected ones with a ``reason`` (or none)."""

    data: DataFrame
    rejects: DataFrame | None = None


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable[[DataFrame, dict], Result | DataFrame]


@dataclass
class Run:
    stages: list[tuple[str, Result]] = field(default_factory=list)
    source: DataFrame | None = None
    config: dict = field(default_factory=dict)

    @property
    def data(self) -> DataFrame:
        return self.stages[-1][1].data if self.stages else self.source

    def rejects(self, key: str) -> DataFrame | None:
        """``(stage, key, reason)`` of all rejected rows."""
        out = None
        for name, r in self.stages:
            if r.rejects is not None:
                one = r.rejects.select(F.lit(name).alias("stage"), F.col(key), "reason" if "reason" in r.rejects.columns else F.lit(None).cast("string").alias("reason"))
                out = one if out is None else out.unionByName(one)
        return out

    def counts(self) -> DataFrame:
        """Rows after each stage and their share of the source's."""
        return funnel([("source", self.source), *[(n, r.data) for n, r in self.stages]])

    def lineage(self, key: str) -> dict:
        """What was run on what: true counts per stage, the configuration, and a hash of both."""
        n = {r["stage"]: r["n"] for r in self.counts().collect()}
        gone = self.rejects(key)
        removed = {r["stage"]: r["count"] for r in gone.groupBy("stage").count().collect()} if gone is not None else {}
        doc = {"version": "1.0", "stages": [s for s, _ in self.stages], "counts": n, "removed": removed, "config": self.config}
        doc["id"] = hashlib.sha256(json.dumps(doc, sort_keys=True, default=str).encode()).hexdigest()[:16]
        return doc


class Pipeline:
    """Stages run one after another; ``only`` picks some by name, ``start`` begins at one."""

    def __init__(self, stages: Sequence[Stage]):
        self.stages = list(stages)

    def run(self, df: DataFrame, config: dict | None = None, only: Sequence[str] | None = None, start: str | None = None) -> Run:
        names = [s.name for s in self.stages]
        for n in [*(only or []), *([start] if start else [])]:
            if n not in names:
                raise ValueError(f"no stage {n}")
        out = Run(source=df, config=config or {})
        for s in self.stages[names.index(start) if start else 0 :]:
            if only is None or s.name in only:
                r = s.run(out.data, out.config)
                out.stages.append((s.name, r if isinstance(r, Result) else Result(r)))
        return out
