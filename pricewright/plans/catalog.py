"""All registered queries and their checking SQL."""

from __future__ import annotations

from pricewright.plans import collect, encode, explore, model, runs, storage, text  # noqa: F401
from pricewright.plans.registry import REGISTRY, runner


def queries():
    return {name: runner(q) for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}


def coverage() -> dict[str, list[str]]:
    """Inventory id -> names of the queries that exercise it."""
    out: dict[str, list[str]] = {}
    for q in REGISTRY.values():
        for i in q.ids:
            out.setdefault(i, []).append(q.name)
    return out
