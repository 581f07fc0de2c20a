"""The registered queries: each runs one operator over the analytics tables and names its oracle SQL."""

from tidemark.plans.registry import REGISTRY, oracle_sql, queries

__all__ = ["REGISTRY", "oracle_sql", "queries"]
