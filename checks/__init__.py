"""Checked queries: every operator over the given tables, next to the SQL that must give the same rows."""

import importlib

AREAS = ["windows", "sequence", "extraction", "sources", "isoforms", "hits", "panels", "variants"]


def load():
    from . import registry
    for area in AREAS:
        importlib.import_module(f"{__name__}.{area}")
    return registry.QUERIES, registry.SQL
