"""All registered queries."""

from headway.plans import model_queries, profile_queries, table_queries  # noqa: F401
from headway.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
