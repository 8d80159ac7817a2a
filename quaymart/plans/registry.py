"""Query registry: name -> (callable, SQL twin or None)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL_TWINS: dict[str, str] = {}

FAMILIES = ("filters", "rentals", "marts", "aggregates", "windows", "timeseries", "quality",
            "loading", "history", "models", "training")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL_TWINS[name] = sql
        return fn

    return add


def load_all() -> None:
    for family in FAMILIES:
        importlib.import_module(f"quaymart.plans.{family}")
