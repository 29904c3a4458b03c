"""Named queries over the driver tables, each with its DuckDB oracle where one exists."""

from __future__ import annotations


def load_all():
    """Import every query module (registration happens on import) and return the registry."""
    from cellar.plans import core  # noqa: F401
    from cellar.plans.registry import ORACLE, QUERIES

    for mod in ("text", "recommend", "models", "pages", "files"):
        try:
            __import__(f"cellar.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"cellar.plans.{mod}":
                raise
    return QUERIES, ORACLE
