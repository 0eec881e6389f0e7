"""Registry of the core queries and of the SQL they are checked against."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("redaction", "parsing")


def queries() -> dict:
    out: dict = {}
    for name in _MODULES:
        out |= import_module(f"veilwork.plans.{name}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in _MODULES:
        out |= import_module(f"veilwork.plans.{name}").ORACLE
    return out
