"""Filters, membership facets, top-k."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.functions import contains_ci


def top_k(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows of an order; planned as one heap per task, no full sort.

    The order should end in a key, so that ties at the cut repeat.
    """
    return df.orderBy(*order).limit(n)


def facets(df: DataFrame, isin: dict[str, Iterable] | None = None,
           at_least: dict[str, float] | None = None,
           search: dict[str, str] | None = None) -> DataFrame:
    """Optional facets: membership lists, lower bounds, substring search.

    An absent or empty facet does not filter. All of them are plain predicates
    on columns, so they reach the scan.
    """
    for col, values in (isin or {}).items():
        values = list(values)
        if values:
            df = df.where(F.col(col).isin(values))
    for col, bound in (at_least or {}).items():
        if bound is not None:
            df = df.where(F.col(col) >= bound)
    for col, needle in (search or {}).items():
        if needle:
            df = df.where(contains_ci(col, needle))
    return df


def half_open(ts: Column | str, start: str, end: str) -> Column:
    """``start <= ts < end`` on a timestamp without zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return (c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz"))
