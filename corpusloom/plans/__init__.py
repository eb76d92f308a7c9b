"""Queries over the driver's tables, by theme, and their DuckDB forms."""

from __future__ import annotations


def _modules():
    from . import social, texts, upkeep

    return [social, texts, upkeep]


def queries() -> dict:
    return {k: f for m in _modules() for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _modules() for k, s in m.ORACLE.items()}
