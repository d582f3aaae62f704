"""The registered queries and, for each, SQL that gives the same rows."""

from tableflow.catalog import arrival, joins, loads, maintenance, streams  # noqa: F401
from tableflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
