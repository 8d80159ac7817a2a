"""Binning and encoding rules. The NULL rule of each is part of its contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment names from lowest to highest, with their ordinal codes.
SEGMENTS = ("Bronze", "Silver", "Gold", "Platinum")
SEGMENT_CODES = {"Bronze": 0, "Silver": 1, "Gold": 2, "Platinum": 3}
# Lifetime-value cuts, spend-bin edges, price-tier cuts and names.
LTV_CUTS = (100, 200, 500)
SPEND_EDGES = (0, 50, 100, 150)
TIER_CUTS = (0.99, 2.99)
TIERS = ("Budget", "Standard", "Premium")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cut_right_closed(x: Column | str, edges: Sequence[float] = SPEND_EDGES,
                     labels: Sequence[str] = SEGMENTS) -> Column:
    """Right-closed bins ``(e0,e1] (e1,e2] ... (en,inf)``; NULL at or below e0."""
    c = _col(x)
    out = F.when(c.isNull() | (c <= edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        out = out.when(c <= upper, label)
    return out.otherwise(labels[len(edges) - 1])


def floor_segment(x: Column | str, cuts: Sequence[float] = LTV_CUTS,
                  labels: Sequence[str] = SEGMENTS) -> Column:
    """Left-closed segments: below the first cut, and NULL, is the lowest."""
    c = _col(x)
    out = None
    for cut, label in zip(reversed(cuts), reversed(labels)):
        out = F.when(c >= cut, label) if out is None else out.when(c >= cut, label)
    return out.otherwise(labels[0])


def price_tier(rate: Column | str, cuts: Sequence[float] = TIER_CUTS,
               labels: Sequence[str] = TIERS) -> Column:
    """Tier by upper bounds; a missing rate falls into the last tier."""
    c = _col(rate)
    out = F.when(c <= cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        out = out.when(c <= cut, label)
    return out.otherwise(labels[-1])


def ordinal(x: Column | str, codes: dict[str, int] = SEGMENT_CODES, default: int = 0) -> Column:
    """Code of a label; unknown or missing labels get ``default``."""
    c = _col(x)
    out = None
    for label, code in codes.items():
        out = F.when(c == label, code) if out is None else out.when(c == label, code)
    return out.otherwise(default)
