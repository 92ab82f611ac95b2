"""The library's operators as queries over the star-schema test tables, each with its SQL twin."""

from tidemark.queries.registry import QUERIES, SQL
from tidemark.queries import layers, marts, rows, storage  # noqa: F401  (fill the registry)

__all__ = ["QUERIES", "SQL"]
