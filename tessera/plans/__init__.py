"""Registered queries: one per operator of the blueprint's inventory."""

from . import q_boost, q_groups, q_learn, q_model, q_rows  # noqa: F401  (registers slugs)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
