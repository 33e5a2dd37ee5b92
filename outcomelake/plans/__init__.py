"""Registered queries over the given tables."""

from __future__ import annotations

from importlib import import_module

_MODULES = (
    "positions_queries", "intent_queries", "fill_queries", "panel_queries", "lake_queries", "quality_queries",
)


def _load():
    registry = import_module("outcomelake.plans.registry")
    for module in _MODULES:
        import_module(f"outcomelake.plans.{module}")
    return registry


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
