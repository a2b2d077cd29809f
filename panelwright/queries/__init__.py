"""Registered queries with their DuckDB counterparts."""

from importlib import import_module

FAMILIES = ("markets", "scalars", "relational", "panels", "rolling", "accounting", "securities", "portfolios", "temporal")


def load():
    """Import every query family once and return the registry module."""
    for name in FAMILIES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")
