"""Queries by name, each with its SQL."""

from __future__ import annotations


class Book:
    def __init__(self) -> None:
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        """Enters a function under its name, with the SQL that gives the same rows where there is one."""

        def add(fn):
            self.queries[fn.__name__] = fn
            if sql:
                self.sql[fn.__name__] = sql
            return fn

        return add
