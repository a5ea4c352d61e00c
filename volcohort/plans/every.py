"""All queries and their SQL."""

from __future__ import annotations

from volcohort.plans.register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
