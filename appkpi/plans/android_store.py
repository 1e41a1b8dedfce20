"""Android store: app health, daily store statistics, reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appkpi.functions import ratio, timestamp_day
from appkpi.operators import merge_on_keys
from appkpi.plans.contracts import HEALTH_KEY


def _rates(df: DataFrame, rate: str) -> DataFrame:
    return df.select(*HEALTH_KEY, *[c for c in df.columns if c.startswith(rate)])


def app_health(
    crash: DataFrame, anr: DataFrame, wakelock: DataFrame, wakeup: DataFrame
) -> DataFrame:
    """The four rates side by side; each staging table holds every key once."""
    return merge_on_keys(
        {
            "crash": _rates(crash, "crash_rate"),
            "anr": _rates(anr, "anr_rate"),
            "wakelock": _rates(wakelock, "stuck_bg_wakelock_rate"),
            "wakeup": _rates(wakeup, "excessive_wakeup_rate"),
        },
        HEALTH_KEY,
    )


def store_stats(
    installs: DataFrame, store_performance: DataFrame, crashes: DataFrame
) -> DataFrame:
    """Installs, store page traffic over all countries, and crash counts per day."""
    traffic = store_performance.groupBy("date").agg(
        F.sum("store_listing_visitors").alias("store_listing_impressions"),
        F.sum("store_listing_acquisitions").alias("store_listing_acquisitions"),
    )
    install_columns = (
        "daily_device_installs",
        "daily_device_uninstalls",
        "daily_device_upgrades",
        "active_device_installs",
        "install_events",
        "uninstall_events",
    )
    merged = merge_on_keys(
        {
            "installs": installs.select("date", *install_columns),
            "traffic": traffic,
            "crashes": crashes.select("date", "daily_crashes", "daily_anrs"),
        },
        ["date"],
    )
    return merged.select(
        "date",
        F.lit("android").alias("platform"),
        *install_columns,
        "store_listing_impressions",
        "store_listing_acquisitions",
        ratio("store_listing_acquisitions", "store_listing_impressions").alias(
            "store_listing_conversion_rate"
        ),
        "daily_crashes",
        "daily_anrs",
    )


def reviews(staged: DataFrame) -> DataFrame:
    """Reviews with their day and two flags; an unknown rating has an unknown flag."""
    return staged.withColumns(
        {
            "review_date": timestamp_day("last_modified_at_ts"),
            "has_developer_reply": F.col("developer_reply_text").isNotNull(),
            "is_negative_review": F.col("star_rating") <= 2,
        }
    )
