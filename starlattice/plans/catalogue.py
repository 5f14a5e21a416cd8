"""All registered queries and their check SQL."""

from starlattice.plans import (  # noqa: F401
    cuboid_queries,
    dashboard_queries,
    distinct_queries,
    load_flow_queries,
    load_queries,
    navigation_queries,
)
from starlattice.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
