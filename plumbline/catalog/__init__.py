"""The registered queries of the engine and their SQL counterparts."""

from __future__ import annotations

from . import index_queries, market_queries, method_queries

MODULES = [index_queries, market_queries, method_queries]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.S.items()}
