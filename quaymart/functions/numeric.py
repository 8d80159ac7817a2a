"""Exact money and ratio arithmetic.

Money is summed as whole cents in a ``bigint``: the sum does not depend on the
order of rows, stays inside whole-stage codegen, and overflows loudly under
ANSI. A ratio of two integers is divided once in double precision, so a true
half always rounds as a half, whatever engine does the division.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_cents(amount: Column | str) -> Column:
    """Money with two decimals (decimal or double) as whole cents."""
    return F.floor(_col(amount).cast("double") * 100 + 0.5)


def from_cents(cents: Column | str) -> Column:
    return _col(cents).cast("double") / 100.0


def half_up(x: Column) -> Column:
    """Nearest whole number, halves away from zero (SQL ``ROUND`` on numeric)."""
    return F.round(x, 0)


def ratio(num: Column | str, den: Column | str, digits: int = 2, num_scale: int = 0,
          half: str = "up") -> Column:
    """``num / den`` rounded to ``digits``; NULL when ``den`` is 0 or NULL.

    ``num`` counts units of 10^-num_scale (cents: 2). ``half="even"`` follows
    the numpy rounding rule of the dataframe-style queries.
    """
    scaled = _col(num).cast("double") * float(10 ** (digits - num_scale)) \
        if digits >= num_scale else _col(num).cast("double") / float(10 ** (num_scale - digits))
    quotient = F.try_divide(scaled, _col(den).cast("double"))
    whole = half_up(quotient) if half == "up" else F.rint(quotient)
    return whole / float(10 ** digits)


def pct(part: Column | str, total: Column | str, digits: int = 2, half: str = "up") -> Column:
    """``part / total * 100`` rounded to ``digits``; both in the same unit."""
    quotient = F.try_divide(_col(part).cast("double") * float(10 ** (digits + 2)),
                            _col(total).cast("double"))
    whole = half_up(quotient) if half == "up" else F.rint(quotient)
    return whole / float(10 ** digits)


def pct_change(now: Column | str, before: Column | str, digits: int = 2, half: str = "even") -> Column:
    """Growth over ``before`` in percent; NULL on the first row or a zero base."""
    return pct(_col(now) - _col(before), before, digits, half)


def rint_to(x: Column | str, digits: int) -> Column:
    """numpy-style rounding: halves to even after scaling."""
    return F.rint(_col(x) * float(10 ** digits)) / float(10 ** digits)
