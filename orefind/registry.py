"""The queries of the core library, with their oracle SQL."""

from __future__ import annotations

from orefind.plans import catalog_queries, engine_queries, packed_queries, search_queries, text_queries

_MODULES = (packed_queries, search_queries, catalog_queries, text_queries, engine_queries)


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in _MODULES for k, v in m.ORACLE.items()}
