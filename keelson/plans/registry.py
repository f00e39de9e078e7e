"""All registered queries: name -> (Spark query, equivalent SQL or None)."""

from __future__ import annotations

from keelson.plans import cleaning, features, models, profiling, storage

REGISTRY = {**storage.QUERIES, **profiling.QUERIES, **cleaning.QUERIES, **features.QUERIES, **models.QUERIES}


def queries() -> dict:
    return {name: query for name, (query, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql}
