from couchlog.sources.days import (
    SEARCH_SCHEMA,
    VIEW_SCHEMA,
    NoDataError,
    days_read,
    flatten_envelope,
    json_days,
    lost_lines,
    parquet_days,
    read_daily_json,
    read_parquet_days,
    unreadable_lines,
    with_day,
)
from couchlog.sources.state import deliveries, read_state, take_in
from couchlog.sources.tables import (
    count_jdbc,
    read_jdbc,
    read_table,
    remove,
    split_by_text,
    stage,
    stage_root,
    staging,
    write_jdbc,
    write_table,
)

__all__ = [
    "NoDataError",
    "SEARCH_SCHEMA",
    "VIEW_SCHEMA",
    "count_jdbc",
    "days_read",
    "deliveries",
    "flatten_envelope",
    "json_days",
    "lost_lines",
    "parquet_days",
    "read_daily_json",
    "read_jdbc",
    "read_parquet_days",
    "read_state",
    "read_table",
    "remove",
    "split_by_text",
    "stage",
    "stage_root",
    "staging",
    "take_in",
    "unreadable_lines",
    "with_day",
    "write_jdbc",
    "write_table",
]
