"""Import every query module so the registry is complete."""

from strata.plans import (cleansing_queries, hierarchy_queries,  # noqa: F401
                          indicator_queries, nested_queries, text_queries, analytics_queries)
from strata.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
