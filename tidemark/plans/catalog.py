"""All registered queries of the library."""

from __future__ import annotations

from tidemark.plans import feature_queries, more_queries, operator_queries, store_queries  # noqa: F401
from tidemark.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
