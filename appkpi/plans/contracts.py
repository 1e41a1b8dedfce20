"""What every staging table reads: raw column, type, natural key.

All names, types and keys below are fixed values: they are the tables' meaning.
"""

from __future__ import annotations

from dataclasses import dataclass

# A field is (name, type) or (name, type, raw column). The type ``day`` is the UTC calendar
# day of a timestamp text.
Field = tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    raw: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    load_columns: tuple[str, ...]
    # For wide keys that no reader groups or merges on as a whole, see ``keep_latest``.
    sort_by_hash: bool = False


ATTRIBUTION_LOAD = (
    "_platform",
    "_app_id",
    "_ingested_at",
    "_run_id",
    "_extract_from",
    "_extract_to",
)
REPORT_LOAD = ("_ingested_at", "_source", "_run_id", "_extract_from", "_extract_to")
SNAPSHOT_LOAD = ("_ingested_at", "_source", "_run_id")


def _text(*names: str) -> tuple[Field, ...]:
    return tuple((n, "string") for n in names)


def _count(*names: str) -> tuple[Field, ...]:
    return tuple((n, "bigint") for n in names)


INSTALL_KEY = ("appsflyer_id", "install_date", "_platform")

INSTALL_HEAD = (
    ("install_time", "timestamp", "Install Time"),
    ("install_date", "day", "Install Time"),
    ("media_source", "string", "Media Source"),
)
CAMPAIGN_NAMES = (
    ("campaign", "string", "Campaign"),
    ("campaign_id", "string", "Campaign ID"),
)
PLACE = (
    ("country_code", "string", "Country Code"),
    ("platform", "string", "Platform"),
)

HEALTH_KEY = ("date", "version_code", "device_model", "api_level", "country_code")
METRIC_HEAD = (("date", "date"), *_text("aggregation_period", "metric_set"))
VERSION = ("version_code", "bigint", "versionCode")
DEVICE = ("device_model", "string", "deviceModel")
API_LEVEL = ("api_level", "bigint", "apiLevel")
COUNTRY = ("country_code", "string", "countryCode")


def _rate(name: str, raw: str, bounds: bool = False) -> tuple[Field, ...]:
    """A rate with its user-weighted averages and, for two of them, confidence bounds."""
    interval = (
        (f"{name}_ci_lower", "double", f"{raw}_ci_lower"),
        (f"{name}_ci_upper", "double", f"{raw}_ci_upper"),
    )
    return (
        (name, "double", raw),
        *(interval if bounds else ()),
        (f"{name}_7d", "double", f"{raw}7dUserWeighted"),
        (f"{name}_28d", "double", f"{raw}28dUserWeighted"),
    )


def _health(raw_table: str, name: str, raw: str, bounds: bool = False) -> Contract:
    return Contract(
        raw_table,
        (*METRIC_HEAD, VERSION, DEVICE, API_LEVEL, COUNTRY, *_rate(name, raw, bounds)),
        HEALTH_KEY,
        REPORT_LOAD,
    )


IOS_HEAD = (("date", "date"), *_text("app_name", "app_apple_identifier"))


def _ios(raw_table: str, fields: tuple[Field, ...], key: tuple[str, ...]) -> Contract:
    return Contract(raw_table, (*IOS_HEAD, *fields), ("date", *key), REPORT_LOAD, sort_by_hash=True)


CONTRACTS: dict[str, Contract] = {
    # ---- attribution ----
    "stg_appsflyer_installs": Contract(
        "raw_installs",
        (
            ("appsflyer_id", "string", "Appsflyer ID"),
            *INSTALL_HEAD,
            *CAMPAIGN_NAMES,
            ("adset", "string", "Adset"),
            ("ad", "string", "Ad"),
            *PLACE,
        ),
        INSTALL_KEY,
        ATTRIBUTION_LOAD,
    ),
    "stg_appsflyer_in_app_events": Contract(
        "raw_in_app_events",
        (
            ("appsflyer_id", "string", "Appsflyer ID"),
            ("event_name", "string", "Event Name"),
            ("event_time", "timestamp", "Event Time"),
            ("event_date", "day", "Event Time"),
            ("media_source", "string", "Media Source"),
            *CAMPAIGN_NAMES,
            *PLACE,
        ),
        (),  # never de-duplicated
        ATTRIBUTION_LOAD,
    ),
    "stg_appsflyer_blocked_installs": Contract(
        "raw_blocked_installs",
        (
            ("appsflyer_id", "string", "AppsFlyer ID"),
            *INSTALL_HEAD,
            *CAMPAIGN_NAMES,
            *PLACE,
            ("blocked_reason", "string", "Attributed Touch Type"),
        ),
        INSTALL_KEY,
        ATTRIBUTION_LOAD,
    ),
    "stg_appsflyer_campaign_performance": Contract(
        "raw_campaign_performance",
        (
            ("date", "day", "Install Time"),
            ("media_source", "string", "Media Source"),
            ("campaign", "string", "Campaign"),
            ("country_code", "string", "GEO"),
            ("impressions", "bigint", "Impressions"),
            ("clicks", "bigint", "Clicks"),
            ("installs", "bigint", "Installs"),
            ("cost", "double", "Cost"),
        ),
        ("date", "media_source", "campaign", "country_code", "_platform"),
        ATTRIBUTION_LOAD,
    ),
    # ---- campaigns ----
    "stg_moengage_campaigns": Contract(
        "raw_campaigns",
        (
            *_text("campaign_id", "channel", "status", "campaign_delivery_type"),
            ("created_at", "timestamp"),
            ("sent_time", "timestamp"),
            *_text("basic_details", "segmentation_details", "conversion_goal_details"),
        ),
        ("campaign_id",),
        REPORT_LOAD,
    ),
    "stg_moengage_campaign_stats": Contract(
        "raw_campaign_stats",
        (
            *_text("campaign_id", "platform", "locale", "variation"),
            *_count("sent", "impression", "click"),
            ("ctr", "double"),
            *_count("attempted", "failed", "device_start"),
            ("delivery_rate", "double"),
            ("sent_rate", "double"),
            ("failure_rate", "double"),
            *_text("delivery_funnel", "conversion_goal_stats"),
        ),
        ("campaign_id", "platform", "locale", "variation", "_extract_from"),
        REPORT_LOAD,
    ),
    # ---- Android store ----
    "stg_play_console_crash_rate": _health("raw_crash_rate", "crash_rate", "crashRate", True),
    "stg_play_console_anr_rate": _health("raw_anr_rate", "anr_rate", "anrRate", True),
    "stg_play_console_stuck_bg_wakelock_rate": _health(
        "raw_stuck_bg_wakelock_rate", "stuck_bg_wakelock_rate", "stuckBgWakelockRate"
    ),
    "stg_play_console_excessive_wakeup_rate": _health(
        "raw_excessive_wakeup_rate", "excessive_wakeup_rate", "excessiveWakeupRate"
    ),
    "stg_play_console_error_count": Contract(
        "raw_error_count",
        (
            *METRIC_HEAD,
            ("report_type", "string", "reportType"),
            VERSION,
            DEVICE,
            API_LEVEL,
            ("error_report_count", "bigint", "errorReportCount"),
            ("distinct_users", "bigint", "distinctUsers"),
        ),
        ("date", "report_type", "version_code", "device_model", "api_level"),
        REPORT_LOAD,
    ),
    "stg_play_console_slow_start_rate": Contract(
        "raw_slow_start_rate",
        (
            *METRIC_HEAD,
            VERSION,
            ("start_type", "string", "startType"),
            DEVICE,
            API_LEVEL,
            COUNTRY,
            *_rate("slow_start_rate", "slowStartRate"),
        ),
        (*HEALTH_KEY, "start_type"),
        REPORT_LOAD,
    ),
    "stg_play_console_reviews": Contract(
        "raw_reviews",
        (
            *_text("review_id", "author_name"),
            ("review_text", "string", "text"),
            ("star_rating", "bigint"),
            *_text("reviewer_language", "device"),
            *_count("android_os_version", "app_version_code"),
            *_text(
                "app_version_name", "device_product_name", "device_manufacturer", "device_class"
            ),
            ("device_ram_mb", "bigint"),
            ("last_modified_at", "bigint", "last_modified_seconds"),
            ("developer_reply_text", "string"),
            ("developer_reply_at", "bigint", "developer_reply_seconds"),
        ),
        ("review_id",),
        SNAPSHOT_LOAD,
    ),
    "stg_play_console_gcs_installs": Contract(
        "raw_gcs_installs",
        (
            ("date", "date"),
            ("package_name", "string"),
            *_count(
                "daily_device_installs",
                "daily_device_uninstalls",
                "daily_device_upgrades",
                "total_user_installs",
                "daily_user_installs",
                "daily_user_uninstalls",
                "active_device_installs",
                "install_events",
                "update_events",
                "uninstall_events",
            ),
        ),
        ("date",),
        REPORT_LOAD,
    ),
    "stg_play_console_gcs_crashes": Contract(
        "raw_gcs_crashes",
        (("date", "date"), ("package_name", "string"), *_count("daily_crashes", "daily_anrs")),
        ("date",),
        REPORT_LOAD,
    ),
    "stg_play_console_gcs_store_performance": Contract(
        "raw_gcs_store_performance_country",
        (
            ("date", "date"),
            ("package_name", "string"),
            ("country", "string", "country___region"),
            *_count("store_listing_acquisitions", "store_listing_visitors"),
            ("store_listing_conversion_rate", "double"),
        ),
        ("date", "country"),
        REPORT_LOAD,
    ),
    # ---- iOS store ----
    "stg_appstore_reviews": Contract(
        "raw_reviews",
        (
            ("review_id", "string"),
            ("rating", "bigint"),
            *_text("title", "body", "reviewer_nickname", "territory"),
            ("created_at_ts", "timestamp", "created_date"),
            ("review_date", "day", "created_date"),
        ),
        ("review_id",),
        REPORT_LOAD,
    ),
    "stg_appstore_app_downloads": _ios(
        "raw_app_downloads",
        (
            *_text("download_type", "app_version", "device", "platform_version", "source_type"),
            *_text("page_type", "pre_order", "territory"),
            ("counts", "bigint"),
        ),
        ("download_type", "app_version", "device", "source_type", "page_type", "territory"),
    ),
    "stg_appstore_app_installs_deletions": _ios(
        "raw_app_installs_deletions",
        (
            *_text("event", "download_type", "app_version", "device", "platform_version"),
            *_text("source_type", "page_type", "app_download_date", "territory"),
            *_count("counts", "unique_devices"),
        ),
        ("event", "download_type", "app_version", "device", "source_type", "territory"),
    ),
    "stg_appstore_app_sessions": _ios(
        "raw_app_sessions",
        (
            *_text("app_version", "device", "platform_version", "source_type"),
            *_text("page_type", "app_download_date", "territory"),
            *_count("sessions", "total_session_duration", "unique_devices"),
        ),
        ("app_version", "device", "source_type", "territory"),
    ),
    "stg_appstore_app_discovery_engagement": _ios(
        "raw_app_discovery_engagement",
        (
            *_text("event", "page_type", "source_type", "engagement_type"),
            *_text("device", "platform_version", "territory"),
            *_count("counts", "unique_counts"),
        ),
        ("event", "page_type", "source_type", "engagement_type", "device", "territory"),
    ),
    "stg_appstore_app_install_performance": _ios(
        "raw_app_install_performance",
        (
            *_text("download_type", "download_info", "install_status", "install_package_type"),
            *_text("device", "platform_version", "territory"),
            *_count("counts", "avg_install_duration"),
        ),
        ("download_type", "install_status", "install_package_type", "device", "territory"),
    ),
}
