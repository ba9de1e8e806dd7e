"""All registered queries."""

from pulseboard.plans import dashboard_queries, functions_queries, shape_queries, stream_queries, table_queries  # noqa: F401
from pulseboard.plans.registry import QUERIES

__all__ = ["QUERIES"]
