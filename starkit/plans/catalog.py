"""All registered queries."""

from __future__ import annotations

from starkit.plans import primitives, star_queries  # noqa: F401  (registering is their effect)
from starkit.plans.registry import REGISTRY


def queries():
    return {name: entry.run for name, entry in REGISTRY.items()}


def oracle_sql():
    return {name: entry.sql for name, entry in REGISTRY.items()}
