"""All registered queries by name."""

from __future__ import annotations

from tidemark.plans import audit_queries, lifecycle_queries, market_queries
from tidemark.plans.query import Query


def catalogue() -> dict[str, Query]:
    merged: dict[str, Query] = {}
    for module in (audit_queries, market_queries, lifecycle_queries):
        twice = merged.keys() & module.REGISTRY.queries.keys()
        if twice:
            raise ValueError(f"queries registered twice: {sorted(twice)}")
        merged.update(module.REGISTRY.queries)
    return merged
