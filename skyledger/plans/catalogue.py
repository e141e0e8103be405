"""All registered queries; importing the modules fills the registry."""

from skyledger.plans import (  # noqa: F401
    queries_cleaning, queries_models, queries_quality, queries_rollups, queries_sources,
)
from skyledger.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
