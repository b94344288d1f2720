"""Registered queries over the star-schema tables; importing this package fills the registry."""

from tidewheel.plans import aggregation_plans, evaluation_plans, feature_plans, master_plans, period_plans, place_plans, segment_plans, time_plans  # noqa: F401
from tidewheel.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
