"""Named queries (one per operator) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from ferret.plans import (q_cleaning, q_metrics, q_models, q_nullity,  # noqa: F401
                              q_profile, q_projection, q_relational, q_roles, q_series)
