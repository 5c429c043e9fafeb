"""All registered queries of the timed-text operators and their DuckDB counterparts."""

from __future__ import annotations

from partwise.plans import audit_queries, cue_queries, interval_queries, speech_queries, visual_queries  # noqa: F401  they register themselves
from partwise.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
