"""Query registry and a small composer for the SQL side."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}
_CTES: dict[str, tuple[str, tuple[str, ...], bool]] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its SQL twin, if it has one."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def cte(name: str, body: str, *needs: str, keep: bool = False) -> None:
    """Name a subquery; ``keep`` asks the engine to compute it once."""
    _CTES[name] = (body, needs, keep)


def sql_of(name: str) -> tuple[str, tuple[str, ...], bool]:
    """Body of a named subquery, what it needs and whether it is kept."""
    return _CTES[name]


def using(needs: str, body: str) -> str:
    """``body`` with a WITH clause holding the named subqueries and all they need."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs.split():
        visit(n)
    parts = [f"{n} AS {'MATERIALIZED ' if _CTES[n][2] else ''}({_CTES[n][0]})" for n in order]
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body
