from couchlog.plans.jobs import content_job, content_job_kept, preview, search_job, search_job_kept, update_searches, update_views
from couchlog.plans.reports import (
    content_bundle,
    content_kpi,
    content_reports,
    distribution,
    interest_sum,
    kpi_long,
    kpi_shares,
    most_watch_labels,
    ranked,
    search_bundle,
    search_kpi,
    search_reports,
    top_contracts,
    top_users,
    watch_hours,
)

__all__ = [
    "content_bundle",
    "content_job",
    "content_job_kept",
    "content_kpi",
    "content_reports",
    "distribution",
    "interest_sum",
    "kpi_long",
    "kpi_shares",
    "most_watch_labels",
    "preview",
    "ranked",
    "search_bundle",
    "search_job",
    "search_job_kept",
    "search_kpi",
    "search_reports",
    "top_contracts",
    "top_users",
    "update_searches",
    "update_views",
    "watch_hours",
]
