"""Loads every query module."""

from kartotek.plans import q_catalog, q_functions, q_incremental, q_projections, q_quality, q_runs, q_sources  # noqa: F401
from kartotek.plans.registry import ORACLES, QUERIES  # noqa: F401
