"""All registered queries and their SQL."""

from terrace.plans import casting, enrichment, job_queries, loads, money_queries, monitoring_queries, relational  # noqa: F401
from terrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
