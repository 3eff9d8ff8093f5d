"""Registered queries: each operator run on the given tables, with an equal SQL statement."""

from tideload.queries import billing, functions, loading, merging, relational, streams, warehouse  # noqa: F401
from tideload.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
