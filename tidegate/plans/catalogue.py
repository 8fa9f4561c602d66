"""All registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from tidegate.plans import control, filefeeds, loading, monitoring, quality

MODULES = (monitoring, loading, filefeeds, control, quality)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.SQL.items()}
