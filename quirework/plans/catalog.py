"""All core queries: importing the plan modules registers them."""

from __future__ import annotations

from quirework.plans import annotated, editorial, passages, proposals, relations, reports, reviewed, searched, served, services  # noqa: F401
from quirework.plans.registry import oracle_sql, queries, register

__all__ = ["oracle_sql", "queries", "register"]
