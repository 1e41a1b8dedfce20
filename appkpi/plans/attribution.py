"""Install attribution, campaign cost, fraud, retention and user quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appkpi.functions import count_where, ratio, zero_if_missing
from appkpi.operators import cohort_retention, merge_on_keys

CAMPAIGN_DAY = ("date", "media_source", "campaign", "country_code", "platform")
OPENED_APP = "SplashScreen_Loading"
CATEGORIES = ("open_app", "login", "purchase", "registrations")


def _per_campaign_day(df: DataFrame, day: str):
    """Rows grouped by day, source, campaign, country and the platform of the load."""
    return df.withColumns({"date": F.col(day), "platform": F.col("_platform")}).groupBy(
        *CAMPAIGN_DAY
    )


def install_attribution(installs: DataFrame) -> DataFrame:
    return installs.select(
        "appsflyer_id",
        "install_date",
        "install_time",
        "media_source",
        "media_type",
        "campaign",
        "campaign_id",
        "adset",
        "ad",
        "country_code",
        "platform",
        "_platform",
        "_app_id",
        "_ingested_at",
    )


def campaign_performance(performance: DataFrame) -> DataFrame:
    """Totals and cost ratios; every ratio is NULL where its denominator is zero."""
    totals = _per_campaign_day(performance, "date").agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "installs", "cost")]
    )
    return totals.withColumns(
        {
            "ctr": ratio("clicks", "impressions"),
            "cpc": ratio("cost", "clicks"),
            "cpi": ratio("cost", "installs"),
            "cpm": ratio("cost", "impressions") * 1000,
        }
    )


def fraud(blocked: DataFrame, installs: DataFrame) -> DataFrame:
    """Blocked share of all install attempts. Both sides are counted before they meet."""
    merged = merge_on_keys(
        {
            "blocked": _per_campaign_day(blocked, "install_date").agg(
                F.count(F.lit(1)).alias("blocked_installs")
            ),
            "installs": _per_campaign_day(installs, "install_date").agg(
                F.count(F.lit(1)).alias("installs")
            ),
        },
        CAMPAIGN_DAY,
    )
    counts = merged.withColumns(
        {c: zero_if_missing(c) for c in ("blocked_installs", "installs")}
    )
    return counts.select(
        *CAMPAIGN_DAY,
        "blocked_installs",
        F.col("blocked_installs").alias("fraud_installs"),
        "installs",
        ratio("blocked_installs", F.col("installs") + F.col("blocked_installs")).alias(
            "fraud_rate"
        ),
    )


def retention(installs: DataFrame, events: DataFrame) -> DataFrame:
    """Share of a day's new users who open the app again exactly 1, 7 and 30 days later."""
    cohort = installs.select(
        "appsflyer_id",
        F.col("install_date").alias("cohort_date"),
        "media_source",
        "campaign",
        "country_code",
        F.col("_platform").alias("platform"),
    )
    opened = events.filter(F.col("event_name") == OPENED_APP)
    return cohort_retention(
        cohort,
        opened,
        user="appsflyer_id",
        cohort_date="cohort_date",
        activity_date="event_date",
        by=("media_source", "campaign", "country_code", "platform"),
    )


def user_quality(events: DataFrame, installs: DataFrame, performance: DataFrame) -> DataFrame:
    """Event counts per category, installs and cost. Cost alone makes no row."""
    merged = merge_on_keys(
        {
            "events": _per_campaign_day(events, "event_date").agg(
                *[count_where(F.col("event_category") == c).alias(c) for c in CATEGORIES]
            ),
            "installs": _per_campaign_day(installs, "install_date").agg(
                F.count(F.lit(1)).alias("installs")
            ),
            "cost": performance.groupBy(*CAMPAIGN_DAY).agg(F.sum("cost").alias("cost")),
        },
        CAMPAIGN_DAY,
        required=("events", "installs"),
    )
    measures = (*CATEGORIES, "installs", "cost")
    filled = merged.withColumns({c: zero_if_missing(c) for c in measures})
    return filled.withColumns(
        {
            "conversion_rate": ratio("registrations", "installs"),
            "cost_per_registration": ratio("cost", "registrations"),
        }
    )
