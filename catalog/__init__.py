"""Queries over the given tables and the SQL they are compared with."""

from catalog import commerce, history, public, quality, records, sources, streams  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
