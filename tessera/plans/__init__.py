"""Registered queries: importing this package fills QUERIES and ORACLE."""

from tessera.plans import q_eval, q_features, q_ml, q_recommend, q_sources, q_stats, q_stream  # noqa: F401
from tessera.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
