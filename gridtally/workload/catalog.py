"""All registered queries."""

from __future__ import annotations

from gridtally.workload import q_enrich, q_factors, q_reports, q_sources  # noqa: F401
from gridtally.workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
