"""Registry of the named queries over the test tables and their SQL oracles.

Each query is a function ``(spark, sf_dir) -> DataFrame`` built from the
library's operators. The oracle is an independent ANSI SQL statement over
the same tables (DuckDB dialect) that must return the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so that its queries register."""
    from ledgerly.plans import (  # noqa: F401
        q_alloc,
        q_joins,
        q_agg,
        q_reports,
        q_filters,
        q_estimates,
        q_projection,
        q_dashboard,
        q_more,
        q_extra,
        q_lists,
        q_finance,
        q_teachers,
        q_commission,
        q_club,
    )
