"""Queries over the given tables, each with its SQL where SQL can say it."""

from appendlake.queries.catalog import QUERIES, Query

# Importing the modules registers their queries.
from appendlake.queries import file_jobs, relational  # noqa: E402,F401

__all__ = ["QUERIES", "Query"]
