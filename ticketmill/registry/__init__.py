"""Every operator as a named query over the sample tables, beside SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ticketmill.registry.oracle import with_models
from ticketmill.samples import Bed


@dataclass(frozen=True)
class Query:
    run: Callable[[Bed], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function of the sample bed under its own name; ``sql`` may use the models."""
    def add(fn: Callable[[Bed], DataFrame]):
        QUERIES[fn.__name__] = Query(fn, with_models(sql) if sql else None)
        return fn
    return add


def load() -> dict[str, Query]:
    from ticketmill.registry import (  # noqa: F401
        boards,
        ingestion,
        models,
        quality,
        rules,
    )
    return QUERIES
