"""Registered queries over the test tables."""

from pairwarden.catalog import (  # noqa: F401
    base_queries,
    event_queries,
    model_queries,
    plan_queries,
    score_queries,
)
from pairwarden.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
