"""Queries over the given tables, one per operator, each with the SQL that gives the same result."""

from queries.registry import QUERIES, SQL
from queries import text, events, jsonlogs, logtypes, streams  # noqa: F401  (they register themselves)

__all__ = ["QUERIES", "SQL"]
