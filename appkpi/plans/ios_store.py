"""iOS store: acquisition funnel, engagement, reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appkpi.functions import ratio, sum_where, zero_if_missing
from appkpi.operators import merge_on_keys

FIRST_TIME = "First-time download"
REDOWNLOAD = "Redownload"


def download_sums() -> list[Column]:
    kind = F.col("download_type")
    return [
        sum_where(kind == FIRST_TIME, "counts").alias("first_time_downloads"),
        sum_where(kind == REDOWNLOAD, "counts").alias("redownloads"),
        F.sum("counts").alias("total_downloads"),
    ]


def session_sums() -> list[Column]:
    names = ("sessions", "total_session_duration", "unique_devices")
    return [F.sum(n).alias(n) for n in names]


def merge_counts(inputs: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inputs merged on the keys, every measure 0 where an input has no row."""
    merged = merge_on_keys(inputs, keys)
    measures = [c for c in merged.columns if c not in keys]
    return merged.withColumns({c: zero_if_missing(c) for c in measures})


def acquisition(downloads: DataFrame, discovery: DataFrame) -> DataFrame:
    event, page = F.col("event"), F.col("page_type")
    daily = merge_counts(
        {
            "downloads": downloads.groupBy("date").agg(*download_sums()),
            "discovery": discovery.groupBy("date").agg(
                sum_where(event == "Impression", "counts").alias("impressions"),
                sum_where((event == "Page view") & (page == "Product page"), "counts").alias(
                    "product_page_views"
                ),
                sum_where(event == "Tap", "counts").alias("page_taps"),
            ),
        },
        ["date"],
    )
    return daily.withColumns(
        {
            "app_units": F.col("first_time_downloads") + F.col("redownloads"),
            "conversion_rate": ratio("first_time_downloads", "impressions"),
        }
    )


def engagement(installs: DataFrame, sessions: DataFrame) -> DataFrame:
    event = F.col("event")
    daily = merge_counts(
        {
            "installs": installs.groupBy("date").agg(
                sum_where(event == "Install", "counts").alias("installs"),
                sum_where(event == "Delete", "counts").alias("deletions"),
                sum_where(event == "Install", "unique_devices").alias("active_devices"),
            ),
            "sessions": sessions.groupBy("date").agg(*session_sums()),
        },
        ["date"],
    )
    return daily.withColumns(
        {
            "avg_session_duration": ratio("total_session_duration", "sessions"),
            "sessions_per_device": ratio("sessions", "unique_devices"),
        }
    )


def reviews(staged: DataFrame) -> DataFrame:
    return staged.select(
        "review_id",
        "rating",
        "title",
        "body",
        "reviewer_nickname",
        "territory",
        "created_at_ts",
        "review_date",
        (F.col("rating") <= 2).alias("is_negative_review"),
        "_ingested_at",
        "_source",
        "_run_id",
    )
