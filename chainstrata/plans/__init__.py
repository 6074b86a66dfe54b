"""Queries on the given tables, each next to the SQL that states the same result."""

from __future__ import annotations

from chainstrata.plans import feeds, fees, ledger, market, models  # noqa: F401  (registration)
from chainstrata.plans.registry import QUERIES, SQL  # noqa: F401
