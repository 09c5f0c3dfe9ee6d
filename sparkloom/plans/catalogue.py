"""All named queries and their SQL."""

from __future__ import annotations

from sparkloom.plans import corpus, evaluation, stages  # noqa: F401  (they register their queries)
from sparkloom.plans.bridges import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
