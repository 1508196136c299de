"""Registry of named queries. Each takes (spark, data folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. `covers` lists the operator ids of the inventory, `sql` is its oracle."""

    def register(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Entry(fn, sql, tuple(covers.split()))
        return fn

    return register
