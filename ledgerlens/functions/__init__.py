"""Column expression helpers (expressions and display formats)."""

from ledgerlens.functions.expr import (
    count_where, days_between, money, month_key, month_offset, pct,
    py_str_2dp, r2, r2_even, ratio, sum_where,
)
from ledgerlens.functions.fmt import fmt_inr, fmt_pct, pct_or_dash

__all__ = [
    "count_where", "days_between", "fmt_inr", "fmt_pct", "money",
    "month_key", "month_offset", "pct", "pct_or_dash", "py_str_2dp", "r2",
    "r2_even", "ratio", "sum_where",
]
