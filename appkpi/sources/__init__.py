"""Reading report files, landing them as raw tables, and writing KPI tables."""

from appkpi.sources.flatten import (
    flatten_android_reviews,
    flatten_campaign_stats,
    flatten_ios_reviews,
    flatten_metric_rows,
)
from appkpi.sources.landing import (
    Load,
    align_to_table,
    append_raw,
    land,
    land_many,
    read_csv_report,
    read_json_rows,
    read_tsv_report,
    snake_case,
    snake_headers,
    stamp,
)
from appkpi.sources.monthly import expected_months, read_monthly_stats
from appkpi.sources.payloads import (
    METRIC_SETS,
    read_campaign_list,
    read_campaign_stats_responses,
    read_ios_review_responses,
    read_metric_responses,
    read_android_review_responses,
)
from appkpi.sources.seeds import EVENT_CATEGORIES, event_mapping, read_event_mapping
from appkpi.sources.tables import publish_view, read_raw, read_table, write_table

__all__ = [
    "EVENT_CATEGORIES",
    "METRIC_SETS",
    "Load",
    "align_to_table",
    "append_raw",
    "event_mapping",
    "expected_months",
    "flatten_android_reviews",
    "flatten_campaign_stats",
    "flatten_ios_reviews",
    "flatten_metric_rows",
    "land",
    "land_many",
    "publish_view",
    "read_android_review_responses",
    "read_campaign_list",
    "read_campaign_stats_responses",
    "read_csv_report",
    "read_event_mapping",
    "read_ios_review_responses",
    "read_json_rows",
    "read_metric_responses",
    "read_monthly_stats",
    "read_raw",
    "read_table",
    "read_tsv_report",
    "snake_case",
    "snake_headers",
    "stamp",
    "write_table",
]
