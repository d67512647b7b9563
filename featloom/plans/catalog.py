"""Imports every query module, so that REGISTRY is complete."""

from featloom.plans import query_cleaning, query_credit, query_models, query_ranks, query_rollups  # noqa: F401
from featloom.plans.registry import REGISTRY  # noqa: F401
