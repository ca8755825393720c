"""Imports every module that registers queries."""

from __future__ import annotations

from loanloom.plans import (  # noqa: F401
    queries_cleaning,
    queries_cohorts,
    queries_decisions,
    queries_evaluation,
    queries_io,
    queries_models,
)
from loanloom.plans.registry import registered

__all__ = ["registered"]
