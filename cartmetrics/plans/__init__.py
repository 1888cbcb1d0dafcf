"""Queries over the test tables, one per operator, each with its oracle statement."""

from cartmetrics.plans import (  # noqa: F401
    agg_plans,
    catalog_plans,
    check_plans,
    decision_plans,
    join_plans,
    kpi_plans,
    profile_plans,
    series_plans,
    std_plans,
)
from cartmetrics.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
