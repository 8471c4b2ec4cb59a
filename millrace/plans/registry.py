"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from millrace.plans import core_queries, data_queries, release_queries, report_queries, source_queries, tag_queries

BOOKS = (core_queries.BOOK, tag_queries.BOOK, report_queries.BOOK, release_queries.BOOK, source_queries.BOOK)
QUERIES = dict(data_queries.QUERIES)
ORACLE = dict(data_queries.ORACLE)
for _book in BOOKS:
    QUERIES |= _book.queries
    ORACLE |= _book.sql

flagship = core_queries.flagship
