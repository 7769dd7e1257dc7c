"""Registered queries, each beside the SQL it has to agree with."""

from queries.registry import ORACLES, QUERIES
from queries import increments, inputs, layers, quality, scans, shaping, verbs  # noqa: F401  (they register)

__all__ = ["ORACLES", "QUERIES"]
