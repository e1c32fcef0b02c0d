"""All registered queries."""

from __future__ import annotations

from reviewmill.plans import (
    check_queries,
    etl_queries,
    experiment_queries,
    feature_queries,
    model_queries,
    quality_queries,
    recommend_queries,
    source_queries,
)
from reviewmill.plans.registry import Query

MODULES = (
    recommend_queries,
    etl_queries,
    quality_queries,
    feature_queries,
    experiment_queries,
    model_queries,
    source_queries,
    check_queries,
)


def queries() -> dict[str, Query]:
    merged: dict[str, Query] = {}
    for module in MODULES:
        overlap = merged.keys() & module.catalog.queries.keys()
        if overlap:
            raise ValueError(f"registered twice: {sorted(overlap)}")
        merged.update(module.catalog.queries)
    return merged


def oracles() -> dict[str, str]:
    merged: dict[str, str] = {}
    for module in MODULES:
        merged.update(module.catalog.oracles)
    return merged
