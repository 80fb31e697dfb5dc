"""Cohort feature and label engine: DataFrames in, one DataFrame out."""

from cohortal.config import CohortConfig, ConditionRule

__all__ = ["CohortConfig", "ConditionRule"]
