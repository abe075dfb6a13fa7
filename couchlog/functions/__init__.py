from couchlog.functions.classify import by_regex, by_value
from couchlog.functions.columns import (
    activity_tier,
    combo_label,
    half_up,
    plan_name,
    ratio,
    share_percent,
    top_label,
)
from couchlog.functions.exact import Amount, amount, checked_sum, exact_avg, exact_sum, odd_total, total

__all__ = [
    "Amount",
    "activity_tier",
    "amount",
    "by_regex",
    "by_value",
    "checked_sum",
    "combo_label",
    "exact_avg",
    "exact_sum",
    "half_up",
    "odd_total",
    "plan_name",
    "ratio",
    "share_percent",
    "top_label",
    "total",
]
