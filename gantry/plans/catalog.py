"""All queries of the library over the driver tables, with their SQL."""

from __future__ import annotations

from gantry.plans import audits, certify, decisions, deltas, domain, lasting, pieces, reconcile, relational, reports, storage  # noqa: F401
from gantry.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
