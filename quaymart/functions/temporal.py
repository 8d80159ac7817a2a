"""Date arithmetic on timestamps without zone (the session runs in UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour days from start to end, truncated toward zero (bigint)."""
    return F.timestamp_diff("DAY", _col(start).cast("timestamp"), _col(end).cast("timestamp"))


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))


def frac_days(start: Column | str, end: Column | str, digits: int = 2) -> Column:
    """Days from start to end with a fraction, rounded half away from zero."""
    from quaymart.functions.numeric import ratio

    return ratio(micros_between(start, end), F.lit(MICROS_PER_DAY), digits)


def month_start(ts: Column | str) -> Column:
    return F.trunc(_col(ts).cast("date"), "month")


def quarter_start(ts: Column | str) -> Column:
    return F.trunc(_col(ts).cast("date"), "quarter")


def week_start(ts: Column | str) -> Column:
    """Monday of the week."""
    return F.trunc(_col(ts).cast("date"), "week")


def month_label(ts: Column | str) -> Column:
    return F.date_format(_col(ts).cast("date"), "yyyy-MM")
