"""Registered queries and their SQL twins."""

from newslake.catalog import articles, corpora, feeds, files, monitoring, pages, runs, stores, streams, texts, vectors
from newslake.catalog.base import QUERIES, SQL

__all__ = [
    "QUERIES", "SQL", "articles", "corpora", "feeds", "files", "monitoring", "pages", "runs", "stores", "streams", "texts", "vectors",
]
