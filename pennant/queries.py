"""All registered queries over the driver's tables and their SQL twins."""

from __future__ import annotations

from pennant.plans import aggregate_queries, conform_queries, feature_queries, feed_queries, join_queries, load_queries, model_queries, window_queries  # noqa: F401
from pennant.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
