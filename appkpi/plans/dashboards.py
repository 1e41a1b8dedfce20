"""Cross-platform dashboard tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appkpi.functions import count_where, ratio, sum_where, zero_if_missing
from appkpi.operators import merge_on_keys, union_branches, with_partition_total
from appkpi.plans.ios_store import download_sums, merge_counts, session_sums

STARS = (1, 2, 3, 4, 5)


def _row_count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def by_app_version(downloads: DataFrame, sessions: DataFrame) -> DataFrame:
    """iOS downloads and sessions per day and app version."""
    keys = ["date", "app_version"]
    merged = merge_counts(
        {
            "downloads": downloads.groupBy(*keys).agg(*download_sums()),
            "sessions": sessions.groupBy(*keys).agg(*session_sums()),
        },
        keys,
    )
    return merged.select(F.lit("ios").alias("platform"), *merged.columns)


def _mean_rates() -> list[Column]:
    """Plain means over the rows, not weighted by users."""
    return [F.avg(r).alias(f"avg_{r}") for r in ("crash_rate", "anr_rate")]


def by_device(health: DataFrame, sessions: DataFrame) -> DataFrame:
    """Android health and iOS sessions per device; what a platform lacks is a typed NULL."""
    android = (
        health.filter(F.col("device_model").isNotNull())
        .groupBy("date", F.col("device_model").alias("device"))
        .agg(*_mean_rates(), _row_count("data_points"))
        .withColumns(
            {
                "platform": F.lit("android"),
                "sessions": F.lit(None).cast("bigint"),
                "unique_devices": F.lit(None).cast("bigint"),
            }
        )
    )
    ios = (
        sessions.filter(F.col("device").isNotNull())
        .groupBy("date", "device")
        .agg(
            F.sum("sessions").alias("sessions"),
            F.sum("unique_devices").alias("unique_devices"),
            _row_count("data_points"),
        )
        .withColumns(
            {
                "platform": F.lit("ios"),
                "avg_crash_rate": F.lit(None).cast("double"),
                "avg_anr_rate": F.lit(None).cast("double"),
            }
        )
    )
    return union_branches(android, ios).select(
        "platform",
        "date",
        "device",
        "avg_crash_rate",
        "avg_anr_rate",
        "sessions",
        "unique_devices",
        "data_points",
    )


def by_os_version(health: DataFrame) -> DataFrame:
    """Android health per day and API level."""
    levels = (
        health.filter(F.col("api_level").isNotNull())
        .groupBy("date", "api_level")
        .agg(*_mean_rates(), _row_count("data_points"))
    )
    return levels.select(
        F.lit("android").alias("platform"),
        "date",
        F.col("api_level").cast("string").alias("os_version"),
        "avg_crash_rate",
        "avg_anr_rate",
        "data_points",
    )


def _daily_ratings(reviews: DataFrame, rating: str) -> DataFrame:
    return reviews.groupBy(F.col("review_date").alias("date")).agg(
        _row_count("total_reviews"),
        F.avg(F.col(rating).cast("double")).alias("avg_rating"),
        count_where(F.col(rating) <= 2).alias("negative_reviews"),
    )


REVIEW_COUNTS = ("total_reviews", "negative_reviews")


def overview_android(health: DataFrame, reviews: DataFrame, stats: DataFrame) -> DataFrame:
    """Android health, ratings and store statistics per day."""
    rates = ("crash_rate", "anr_rate", "excessive_wakeup_rate", "stuck_bg_wakelock_rate")
    merged = merge_on_keys(
        {
            "health": health.groupBy("date").agg(*[F.avg(r).alias(f"avg_{r}") for r in rates]),
            "ratings": _daily_ratings(reviews, "star_rating"),
            "stats": stats.select(
                "date",
                "daily_device_installs",
                "daily_device_uninstalls",
                "store_listing_impressions",
                "store_listing_conversion_rate",
                F.col("daily_crashes").alias("daily_crash_count"),
                F.col("daily_anrs").alias("daily_anr_count"),
            ),
        },
        ["date"],
    )
    filled = merged.withColumns({c: zero_if_missing(c) for c in REVIEW_COUNTS})
    return filled.withColumn("platform", F.lit("android"))


def install_failures(performance: DataFrame) -> DataFrame:
    """Share of install attempts that failed, shown on the dashboard as the crash rate."""
    status = F.col("install_status")
    attempts = (
        performance.filter(status.isin("Success", "Failure"))
        .groupBy("date")
        .agg(
            sum_where(status == "Failure", "counts").alias("failures"),
            F.sum("counts").alias("total_install_attempts"),
        )
    )
    return attempts.select(
        "date",
        ratio("failures", "total_install_attempts").alias("crash_rate"),
        "total_install_attempts",
    )


def overview_ios(
    acquisition: DataFrame,
    engagement: DataFrame,
    reviews: DataFrame,
    install_performance: DataFrame,
) -> DataFrame:
    """iOS acquisition, engagement, ratings and install failures per day.

    Net installs stay NULL on days without engagement data, although installs show 0.
    """
    acquired = (
        "first_time_downloads",
        "redownloads",
        "app_units",
        "impressions",
        "product_page_views",
    )
    engaged = ("installs", "deletions", "sessions", "unique_devices")
    merged = merge_on_keys(
        {
            "acquisition": acquisition.select("date", *acquired, "conversion_rate"),
            "engagement": engagement.select("date", *engaged, "avg_session_duration"),
            "ratings": _daily_ratings(reviews, "rating"),
            "failures": install_failures(install_performance),
        },
        ["date"],
    )
    counts: Sequence[str] = (*acquired, *engaged, *REVIEW_COUNTS, "total_install_attempts")
    return merged.withColumn("net_installs", F.col("installs") - F.col("deletions")).withColumns(
        {"platform": F.lit("ios"), **{c: zero_if_missing(c) for c in counts}}
    )


def _review_ratings(android: DataFrame, ios: DataFrame) -> DataFrame:
    """Platform, day and rating of every review."""
    return union_branches(
        android.select(
            F.lit("android").alias("platform"),
            F.col("review_date").alias("date"),
            F.col("star_rating").alias("rating"),
        ),
        ios.select(F.lit("ios").alias("platform"), F.col("review_date").alias("date"), "rating"),
    )


def rating_distribution(android: DataFrame, ios: DataFrame) -> DataFrame:
    """Reviews per star and their share of the platform. Unrated iOS reviews are left out."""
    unrated_ios = (F.col("platform") == "ios") & F.col("rating").isNull()
    per_star = (
        _review_ratings(android, ios)
        .filter(~unrated_ios)
        .groupBy("platform", "rating")
        .agg(_row_count("review_count"))
    )
    totals = with_partition_total(per_star, "review_count", ["platform"], "total_reviews")
    return totals.withColumn("pct", ratio("review_count", "total_reviews"))


def ratings_daily(android: DataFrame, ios: DataFrame) -> DataFrame:
    """Review count, mean rating and one count per star, per platform and day."""
    rating = F.col("rating")
    return (
        _review_ratings(android, ios)
        .groupBy("date", "platform")
        .agg(
            _row_count("review_count"),
            F.avg(rating.cast("double")).alias("avg_rating"),
            *[count_where(rating == s).alias(f"rating_{s}") for s in STARS],
        )
    )
