"""Registered queries (Spark) and their DuckDB oracle SQL."""

from .registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
