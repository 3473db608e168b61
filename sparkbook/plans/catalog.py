"""All registered queries: importing this module fills ``registry.QUERIES``."""

from __future__ import annotations

from sparkbook.plans import q_book, q_income, q_layers, q_marts, q_positions, q_quality, q_rules, q_scalars, q_sources, q_temporal  # noqa: F401
from sparkbook.plans.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
