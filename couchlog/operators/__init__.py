from couchlog.operators.combine import attach_profiles, union_days
from couchlog.operators.lookup import classify_by_table, rule_table
from couchlog.operators.search import (
    classify_keyword,
    daily_searches,
    explode_plans,
    filter_users,
    interests,
    main_value,
    plan_summary,
    search_activity,
    search_behavior,
    search_profile,
    search_profile_from_daily,
    top_interest,
)
from couchlog.operators.sketches import daily_distinct, daily_frequent, distinct_over, frequent_over
from couchlog.operators.watch import (
    classify_app,
    content_activity,
    content_profile,
    daily_totals,
    days_covered,
    day_limit,
    filter_contract,
    merged_daily,
    most_watch,
    profile_from_daily,
    split_lost,
    taste,
    watch_totals,
)

__all__ = [
    "attach_profiles",
    "classify_app",
    "classify_by_table",
    "classify_keyword",
    "content_activity",
    "content_profile",
    "daily_distinct",
    "daily_frequent",
    "daily_searches",
    "daily_totals",
    "day_limit",
    "days_covered",
    "distinct_over",
    "explode_plans",
    "filter_contract",
    "filter_users",
    "frequent_over",
    "interests",
    "main_value",
    "merged_daily",
    "most_watch",
    "plan_summary",
    "profile_from_daily",
    "rule_table",
    "search_activity",
    "search_behavior",
    "search_profile",
    "search_profile_from_daily",
    "split_lost",
    "taste",
    "top_interest",
    "union_days",
    "watch_totals",
]
