"""All queries of the core by name, and the SQL that states the same."""

from __future__ import annotations

from roundmill.plans.core_queries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
