"""Registered queries over the given tables, each with its SQL twin where one exists."""

from __future__ import annotations

from . import (  # noqa: F401
    subqueries,
    scalars,
    tables,
    relational,
    changes,
    storage,
    streams,
)
from .registry import ORACLES, QUERIES, complete_sql


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: complete_sql(sql) for name, sql in ORACLES.items()}
