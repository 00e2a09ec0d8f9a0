"""The registered queries over the driver's tables and their SQL."""

from __future__ import annotations

import importlib

FLAGSHIP = "q_daily_change_rate"
#: Each module has QUERIES (name to function of session and folder) and ORACLE_SQL (name to DuckDB SQL).
MODULES: tuple[str, ...] = ("timeseries", "merging", "analytics", "texts", "pagesflow", "signals", "rules")


def _gather(what: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(importlib.import_module(f"tallgrass.plans.{name}"), what)
    return found


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict:
    return _gather("ORACLE_SQL")
