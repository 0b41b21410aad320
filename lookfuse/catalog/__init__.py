"""Example queries over the test tables, each with the SQL it has to agree with."""

from lookfuse.catalog import matching, picking, ranges, requests, restrictions, shaping, streams  # noqa: F401
from lookfuse.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
