"""All registered queries with their SQL counterparts."""

from wakeline.registry import flow_queries, globe_queries, join_queries, scan_queries, window_queries
from wakeline.registry.base import ORACLES, QUERIES

MODULES = (scan_queries, join_queries, window_queries, flow_queries, globe_queries)
__all__ = ["MODULES", "ORACLES", "QUERIES"]
