"""Loads every query module, which fills the catalog."""

from __future__ import annotations

from importlib import import_module

MODULES = ("queries_trade", "queries_retail", "queries_events", "queries_models")


def load() -> None:
    for name in MODULES:
        import_module(f"tradeloom.plans.{name}")
