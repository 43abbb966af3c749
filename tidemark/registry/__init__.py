"""Queries over the given tables, with the SQL that must give the same rows."""

from tidemark.registry import examples, increments, monitors, relations, scalars, shapes, sources, streams  # noqa: F401
from tidemark.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
