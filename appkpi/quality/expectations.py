"""The tests and freshness limits of every table. All of them are fixed values."""

from __future__ import annotations

from appkpi.plans.catalog import raw_name
from appkpi.plans.contracts import CONTRACTS
from appkpi.quality.checks import (
    Check,
    accepted_range,
    accepted_values,
    is_true,
    not_null,
    unique,
)
from appkpi.quality.freshness import Freshness


def _present(*columns: str) -> list[Check]:
    return [not_null(c) for c in columns]


def _not_negative(*columns: str) -> list[Check]:
    return [accepted_range(c, low=0).warn() for c in columns]


def _share(*columns: str) -> list[Check]:
    return [accepted_range(c, low=0, high=1).warn() for c in columns]


def _stars(column: str) -> list[Check]:
    return [not_null(column), accepted_range(column, low=1, high=5).warn()]


def _key(column: str) -> list[Check]:
    return [not_null(column), unique(column)]


def _one_of(column: str, *values: str) -> Check:
    return accepted_values(column, values)


LOAD_PLATFORM = [not_null("_platform"), _one_of("_platform", "android", "ios")]

EXPECTATIONS: dict[str, list[Check]] = {
    # ---- attribution ----
    "stg_appsflyer_installs": [
        unique("appsflyer_id", "install_date", "_platform"),
        *_present("appsflyer_id", "install_date", "media_source", "platform"),
        *LOAD_PLATFORM,
    ],
    "stg_appsflyer_in_app_events": [
        *_present("appsflyer_id", "event_name", "event_date"),
        _one_of("event_category", "open_app", "login", "purchase", "registrations").warn(),
        *LOAD_PLATFORM,
    ],
    "stg_appsflyer_blocked_installs": [
        *_present("appsflyer_id", "install_date"),
        not_null("blocked_reason").warn(),
        *LOAD_PLATFORM,
    ],
    "stg_appsflyer_campaign_performance": [
        *_present("date", "media_source", "impressions", "clicks", "installs"),
        *[is_true(c, ">= 0") for c in ("impressions", "clicks", "installs")],
        is_true("cost", ">= 0").warn(),
        *LOAD_PLATFORM,
    ],
    "mart_appsflyer_install_attribution": _present(
        "appsflyer_id", "install_date", "media_source", "platform"
    ),
    "mart_appsflyer_campaign_performance": [
        *_present("date", "media_source", "platform"),
        accepted_range("impressions", low=0),
        *_not_negative("ctr", "cpc", "cpi"),
    ],
    "mart_appsflyer_user_quality": [
        *_present("date", "platform"),
        *_not_negative("cost_per_registration"),
    ],
    "mart_appsflyer_retention": [
        *_present("cohort_date", "platform"),
        accepted_range("cohort_size", low=0, inclusive=False),
        *_share("d1_retention", "d7_retention", "d30_retention"),
    ],
    "mart_appsflyer_fraud": [
        *_present("date", "platform"),
        accepted_range("blocked_installs", low=0),
        *_share("fraud_rate"),
    ],
    # ---- campaigns ----
    "stg_moengage_campaigns": [
        *_key("campaign_id"),
        *_present("channel", "status"),
        _one_of(
            "channel", "PUSH", "EMAIL", "SMS", "IN_APP", "CARDS", "CONNECTOR", "ON_SITE"
        ).warn(),
    ],
    "stg_moengage_campaign_stats": [
        *_present("campaign_id", "platform"),
        _one_of("platform", "ANDROID", "IOS", "UNKNOWN", "ALL_PLATFORMS").warn(),
        *_not_negative("sent", "impression", "click", "ctr"),
    ],
    "mart_moengage_push": [
        *_present("campaign_id", "platform", "stats_date_from"),
        *_not_negative("sent", "open_proxy", "click", "click_rate", "open_proxy_rate"),
    ],
    "mart_moengage_campaign_analytics": [
        *_present("campaign_id", "platform", "stats_date_from"),
        *_not_negative("sent", "click_rate", "delivery_rate"),
    ],
    # ---- Android store ----
    "stg_play_console_crash_rate": [
        *_present("date", "version_code"),
        *_share("crash_rate", "crash_rate_7d", "crash_rate_28d"),
    ],
    "stg_play_console_anr_rate": [*_present("date", "version_code"), *_share("anr_rate")],
    "stg_play_console_stuck_bg_wakelock_rate": [
        *_present("date", "version_code"),
        *_share("stuck_bg_wakelock_rate"),
    ],
    "stg_play_console_excessive_wakeup_rate": [
        *_present("date", "version_code"),
        *_share("excessive_wakeup_rate"),
    ],
    "stg_play_console_error_count": [
        *_present("date", "report_type", "version_code"),
        *_not_negative("error_report_count", "distinct_users"),
    ],
    "stg_play_console_slow_start_rate": [
        *_present("date", "version_code", "start_type"),
        _one_of("start_type", "COLD", "WARM", "HOT").warn(),
        *_share("slow_start_rate"),
    ],
    "stg_play_console_reviews": [
        *_key("review_id"),
        *_stars("star_rating"),
        not_null("last_modified_at"),
    ],
    "stg_play_console_gcs_installs": [
        *_key("date"),
        *_not_negative("daily_device_installs", "daily_device_uninstalls"),
    ],
    "stg_play_console_gcs_crashes": [
        *_key("date"),
        *_not_negative("daily_crashes", "daily_anrs"),
    ],
    "stg_play_console_gcs_store_performance": [
        not_null("date"),
        *_not_negative("store_listing_visitors"),
        *_share("store_listing_conversion_rate"),
    ],
    "mart_play_console_app_health": [
        *_present("date", "version_code"),
        *_share("crash_rate", "anr_rate"),
    ],
    "mart_play_console_reviews": [
        *_key("review_id"),
        *_stars("star_rating"),
        not_null("review_date"),
    ],
    "mart_play_console_gcs_stats": [
        *_key("date"),
        *_not_negative("daily_device_installs", "store_listing_impressions"),
    ],
    # ---- iOS store ----
    "stg_appstore_reviews": [
        *_key("review_id"),
        *_stars("rating"),
        not_null("review_date"),
    ],
    "stg_appstore_app_downloads": [
        *_present("date", "download_type"),
        _one_of(
            "download_type",
            "First-time download",
            "Redownload",
            "Auto-update",
            "Manual update",
            "Restore",
        ).warn(),
        *_not_negative("counts"),
    ],
    "stg_appstore_app_installs_deletions": [
        *_present("date", "event"),
        _one_of("event", "Install", "Delete").warn(),
        *_not_negative("counts"),
    ],
    "stg_appstore_app_sessions": [not_null("date"), *_not_negative("sessions")],
    "stg_appstore_app_discovery_engagement": [
        *_present("date", "event"),
        _one_of("event", "Impression", "Page view", "Tap").warn(),
    ],
    "stg_appstore_app_install_performance": [not_null("date"), *_not_negative("counts")],
    "mart_appstore_acquisition": [*_key("date"), *_not_negative("conversion_rate")],
    "mart_appstore_engagement": _key("date"),
    "mart_appstore_reviews": [
        *_key("review_id"),
        not_null("review_date"),
        *_stars("rating"),
    ],
}

DAILY = Freshness(25, 49)
LAGGING = Freshness(73, 97)
MONTHLY_FILE = Freshness(193, 217)
TWO_DAYS = Freshness(49, 73)


def _freshness_rules() -> dict[str, Freshness]:
    rules = {}
    for name in CONTRACTS:
        table = raw_name(name)
        if table.startswith("play_raw.raw_gcs"):
            rules[table] = MONTHLY_FILE
        elif table.startswith("play_raw"):
            rules[table] = LAGGING
        elif table.startswith("appstore_raw"):
            rules[table] = TWO_DAYS
        else:
            rules[table] = DAILY
    rules["play_raw.raw_gcs_store_performance_traffic"] = MONTHLY_FILE
    return rules


FRESHNESS = _freshness_rules()
