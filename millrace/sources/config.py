"""Configuration from several files and the environment, and typed access to it."""

from __future__ import annotations

import json
import os
import tomllib
from collections.abc import Mapping, Sequence
from dataclasses import fields
from pathlib import Path

try:
    import yaml
except ImportError:
    yaml = None


def parse(text: str, kind: str) -> dict:
    """A document of kind json, toml, env, or, where a parser is installed, yaml."""
    if kind == "json":
        return json.loads(text)
    if kind == "toml":
        return tomllib.loads(text)
    if kind in ("yaml", "yml"):
        if yaml is None:
            raise ImportError("no YAML parser is installed")
        return yaml.safe_load(text) or {}
    out = {}
    for line in text.splitlines():
        name, eq, value = line.strip().removeprefix("export ").partition("=")
        if eq and not name.startswith("#"):
            value = value.strip()
            quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "\"'"
            out[name.strip()] = value[1:-1] if quoted else value
    return out


def read(path: str | os.PathLike) -> dict:
    """A configuration file by its suffix (none, or .env: lines name=value); one that isn't there is empty."""
    p = Path(path)
    return parse(p.read_text(encoding="utf-8"), p.suffix[1:] if p.suffix[1:] in ("json", "toml", "yaml", "yml") else "env") if p.exists() else {}


def merged(layers: Sequence[Mapping]) -> dict:
    """Layers put one over another, maps within them, too: a later one wins."""
    out: dict = {}
    for layer in layers:
        for k, v in layer.items():
            out[k] = merged([out[k], v]) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


class Config:
    """Layers of configuration: the environment (of the names that a layer or ``names`` tells) below the project's, below the global one."""

    def __init__(self, project: Mapping | None = None, overall: Mapping | None = None, names: Sequence[str] = (), environment: Mapping | None = None):
        env = os.environ if environment is None else environment
        known = {*names, *(project or {}), *(overall or {})}
        self.values = merged([{n: env[n] for n in known if n in env}, project or {}, overall or {}])

    def get(self, path: str, default=None, kind: type | None = None):
        """The value at "a.b.c", as ``kind``; the default where there is none or it is null."""
        at = self.values
        for part in path.split("."):
            if not isinstance(at, Mapping) or part not in at:
                return default
            at = at[part]
        if at is None:
            return default
        if kind is bool and isinstance(at, str):
            return at.strip().lower() in ("1", "true", "yes", "on")
        return kind(at) if kind else at

    def ready(self, needed: Sequence[str]) -> dict[str, bool]:
        """Whether there is a value that isn't empty, per name."""
        return {n: self.get(n) not in (None, "", [], {}) for n in needed}

    def fill(self, cls: type, path: str):
        """A dataclass of rules from the map at ``path``; what it doesn't tell keeps its default, unknown names are left out."""
        found = self.get(path, {})
        return cls(**{f.name: tuple(found[f.name]) if isinstance(found[f.name], list) else found[f.name] for f in fields(cls) if f.name in found})
