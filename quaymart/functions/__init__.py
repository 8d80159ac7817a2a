"""Column expressions shared by all plans (all JVM-side built-ins)."""

from quaymart.functions.binning import cut_right_closed, floor_segment, ordinal, price_tier
from quaymart.functions.numeric import from_cents, half_up, pct, pct_change, ratio, rint_to, to_cents
from quaymart.functions.temporal import (
    frac_days,
    month_label,
    month_start,
    quarter_start,
    week_start,
    whole_days,
)
from quaymart.functions.text import concat_skip_null, contains_ci, distinct_list

__all__ = [
    "concat_skip_null", "contains_ci", "cut_right_closed", "distinct_list", "floor_segment",
    "frac_days", "from_cents", "half_up", "month_label", "month_start", "ordinal", "pct",
    "pct_change", "price_tier", "quarter_start", "ratio", "rint_to", "to_cents", "week_start",
    "whole_days",
]
