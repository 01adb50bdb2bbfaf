"""Data curation for Spark DataFrames."""

from rinse.plans.config import CurationConfig, PlacementRule
from rinse.plans.curate import CurationResult, curate, curate_data, learn
from rinse.plans.plan import CurationPlan, apply

__all__ = [
    "CurationConfig",
    "CurationPlan",
    "CurationResult",
    "PlacementRule",
    "apply",
    "curate",
    "curate_data",
    "learn",
]
