"""Queries over the register tables, by name, each with its SQL."""

from __future__ import annotations

from .plans import stored  # noqa: F401 - registers its queries
from .plans.queries import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
