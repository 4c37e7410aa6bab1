"""Every named query, one module per part of the inventory."""

from importlib import import_module

MODULES = ("cleaning", "features", "reports", "scoring", "ingest", "models", "outlook")


def all_queries():
    from catalog.registry import QUERIES

    for module in MODULES:
        import_module(f"catalog.{module}")
    return QUERIES
