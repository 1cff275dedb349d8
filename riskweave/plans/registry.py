"""Named queries over the star-schema tables and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFn
    covers: str
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Registers a query; ``covers`` lists the inventory ids it exercises."""
    def add(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(fn, covers, sql)
        return fn
    return add


def load_all() -> dict[str, Query]:
    from riskweave.plans import (  # noqa: F401
        catalog_boosting, catalog_drift, catalog_evaluation, catalog_features, catalog_metrics,
        catalog_model, catalog_quality, catalog_streams,
    )
    return REGISTRY
