"""DataFrame operators the KPI tables are composed of."""

from appkpi.operators.aggregates import with_partition_total
from appkpi.operators.combine import attach_lookup, full_outer_chain, merge_on_keys, union_branches
from appkpi.operators.date_windows import (
    bucket_by_window,
    date_windows,
    half_open,
    in_date_range,
    lagged_window,
    months_between_dates,
    since,
)
from appkpi.operators.latest import keep_latest
from appkpi.operators.retention import cohort_retention

__all__ = [
    "attach_lookup",
    "bucket_by_window",
    "cohort_retention",
    "date_windows",
    "full_outer_chain",
    "half_open",
    "in_date_range",
    "keep_latest",
    "lagged_window",
    "merge_on_keys",
    "months_between_dates",
    "since",
    "union_branches",
    "with_partition_total",
]
