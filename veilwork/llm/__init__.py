"""Operators for training text.  Nothing else in the library imports this subpackage."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("mojibake", "pii", "lookalike", "pieces", "tokens", "leakage", "abuse")


def queries() -> dict:
    out: dict = {}
    for name in _MODULES:
        out |= import_module(f"{__name__}.{name}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in _MODULES:
        out |= import_module(f"{__name__}.{name}").ORACLE
    return out
