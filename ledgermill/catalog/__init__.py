"""Named queries with their reference SQL, one module per operator family."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("silver", "warehouse", "anomaly", "alerts", "graph", "quality", "sources", "streams")


def load():
    """Import every family once and return the filled registry."""
    registry = import_module("ledgermill.catalog.registry")
    for family in FAMILIES:
        import_module(f"ledgermill.catalog.{family}")
    return registry
