"""The query catalogue: every operator as a query over the test tables, with its SQL counterpart."""

from peakweave.plans.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
