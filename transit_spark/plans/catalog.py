"""All registered queries and their reference SQL."""

from __future__ import annotations

from transit_spark.plans import checks_cleaning, checks_features, checks_planning, checks_sources
from transit_spark.plans.registry import ORACLES, QUERIES

MODULES = (checks_cleaning, checks_features, checks_planning, checks_sources)

__all__ = ["MODULES", "ORACLES", "QUERIES"]
