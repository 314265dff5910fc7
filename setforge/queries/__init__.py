"""Registered queries over the given tables, each with oracle SQL where SQL can say it."""

from __future__ import annotations

from importlib import import_module

MODULES = ["core", "documents", "receipts", "pricing"]


def _registries():
    return [import_module(f"setforge.queries.{m}").registry for m in MODULES]


def all_queries() -> dict:
    return {k: q for r in _registries() for k, q in r.queries.items()}


def all_oracles() -> dict[str, str]:
    return {k: s for r in _registries() for k, s in r.oracles.items()}
