"""Every table: what it is computed from and how it is stored."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from appkpi.plans import android_store, attribution, campaigns, dashboards, ios_store
from appkpi.plans.contracts import CONTRACTS
from appkpi.plans.staging import stage, stage_in_app_events

SEED = "appsflyer_event_mapping"

# The two stores both call a raw table ``raw_reviews``; the prefix keeps them apart.
RAW_PREFIX = {
    "stg_appsflyer": "appsflyer_raw",
    "stg_moengage": "moengage_raw",
    "stg_play_console": "play_raw",
    "stg_appstore": "appstore_raw",
}


def raw_name(staging_table: str) -> str:
    """Qualified raw table of a staging table, e.g. ``play_raw.raw_reviews``."""
    prefix = next(p for s, p in RAW_PREFIX.items() if staging_table.startswith(s))
    return f"{prefix}.{CONTRACTS[staging_table].raw}"


@dataclass(frozen=True)
class Table:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    stored: bool = True
    partition_by: str | None = None
    cluster_by: tuple[str, ...] = ()


# Cluster columns of the staging tables that have them.
STAGING_CLUSTERS: dict[str, tuple[str, ...]] = {
    "stg_appsflyer_installs": ("media_source", "campaign"),
    "stg_appstore_app_downloads": ("download_type", "territory"),
    "stg_appstore_app_installs_deletions": ("event", "territory"),
    "stg_appstore_app_sessions": ("device", "territory"),
    "stg_appstore_app_discovery_engagement": ("event", "territory"),
    "stg_appstore_app_install_performance": ("install_status", "territory"),
}


def _staging() -> dict[str, Table]:
    """Staging tables with a key are stored, because the KPI tables and the data tests all
    read them and each read would repeat the shuffle of the whole raw history. In-app events
    have no key and need no shuffle: they stay a view over the raw table.
    """
    tables = {}
    for name, contract in CONTRACTS.items():
        days = [k for k in contract.key if k in ("date", "install_date", "_extract_from")]
        tables[name] = Table(
            partial(stage, name=name),
            (raw_name(name),),
            stored=bool(contract.key),
            partition_by=days[0] if days else None,
            cluster_by=STAGING_CLUSTERS.get(name, ()),
        )
    events = "stg_appsflyer_in_app_events"
    tables[events] = Table(stage_in_app_events, (raw_name(events), SEED), stored=False)
    return tables


def _mart(build, inputs: tuple[str, ...], partition_by: str, *cluster_by: str) -> Table:
    return Table(build, inputs, True, partition_by, cluster_by)


BY_CAMPAIGN = ("media_source", "campaign", "platform")

# Inputs come before the tables that read them.
TABLES: dict[str, Table] = {
    **_staging(),
    "mart_appsflyer_install_attribution": _mart(
        attribution.install_attribution,
        ("stg_appsflyer_installs",),
        "install_date",
        *BY_CAMPAIGN,
    ),
    "mart_appsflyer_campaign_performance": _mart(
        attribution.campaign_performance,
        ("stg_appsflyer_campaign_performance",),
        "date",
        *BY_CAMPAIGN,
    ),
    "mart_appsflyer_fraud": _mart(
        attribution.fraud,
        ("stg_appsflyer_blocked_installs", "stg_appsflyer_installs"),
        "date",
        *BY_CAMPAIGN,
    ),
    "mart_appsflyer_retention": _mart(
        attribution.retention,
        ("stg_appsflyer_installs", "stg_appsflyer_in_app_events"),
        "cohort_date",
        *BY_CAMPAIGN,
    ),
    "mart_appsflyer_user_quality": _mart(
        attribution.user_quality,
        (
            "stg_appsflyer_in_app_events",
            "stg_appsflyer_installs",
            "mart_appsflyer_campaign_performance",
        ),
        "date",
        *BY_CAMPAIGN,
    ),
    "mart_moengage_push": _mart(
        campaigns.push_metrics,
        ("stg_moengage_campaign_stats", "stg_moengage_campaigns"),
        "stats_date_from",
        "platform",
        "channel",
    ),
    "mart_moengage_campaign_analytics": _mart(
        campaigns.campaign_analytics,
        ("stg_moengage_campaign_stats", "stg_moengage_campaigns"),
        "stats_date_from",
        "platform",
        "channel",
    ),
    "mart_play_console_app_health": _mart(
        android_store.app_health,
        (
            "stg_play_console_crash_rate",
            "stg_play_console_anr_rate",
            "stg_play_console_stuck_bg_wakelock_rate",
            "stg_play_console_excessive_wakeup_rate",
        ),
        "date",
        "version_code",
    ),
    "mart_play_console_gcs_stats": _mart(
        android_store.store_stats,
        (
            "stg_play_console_gcs_installs",
            "stg_play_console_gcs_store_performance",
            "stg_play_console_gcs_crashes",
        ),
        "date",
    ),
    "mart_play_console_reviews": _mart(
        android_store.reviews, ("stg_play_console_reviews",), "review_date", "star_rating"
    ),
    "mart_appstore_acquisition": _mart(
        ios_store.acquisition,
        ("stg_appstore_app_downloads", "stg_appstore_app_discovery_engagement"),
        "date",
    ),
    "mart_appstore_engagement": _mart(
        ios_store.engagement,
        ("stg_appstore_app_installs_deletions", "stg_appstore_app_sessions"),
        "date",
    ),
    "mart_appstore_reviews": _mart(
        ios_store.reviews, ("stg_appstore_reviews",), "review_date", "rating"
    ),
    "dash_acquisition_by_app_version": _mart(
        dashboards.by_app_version,
        ("stg_appstore_app_downloads", "stg_appstore_app_sessions"),
        "date",
        "platform",
        "app_version",
    ),
    "dash_acquisition_by_device": _mart(
        dashboards.by_device,
        ("mart_play_console_app_health", "stg_appstore_app_sessions"),
        "date",
        "platform",
        "device",
    ),
    "dash_acquisition_by_os_version": _mart(
        dashboards.by_os_version,
        ("mart_play_console_app_health",),
        "date",
        "platform",
        "os_version",
    ),
    "dash_overview_android": _mart(
        dashboards.overview_android,
        (
            "mart_play_console_app_health",
            "mart_play_console_reviews",
            "mart_play_console_gcs_stats",
        ),
        "date",
        "platform",
    ),
    "dash_overview_ios": _mart(
        dashboards.overview_ios,
        (
            "mart_appstore_acquisition",
            "mart_appstore_engagement",
            "mart_appstore_reviews",
            "stg_appstore_app_install_performance",
        ),
        "date",
        "platform",
    ),
    "dash_rating_distribution": Table(
        dashboards.rating_distribution,
        ("mart_play_console_reviews", "mart_appstore_reviews"),
        cluster_by=("platform", "rating"),
    ),
    "dash_ratings_daily": _mart(
        dashboards.ratings_daily,
        ("mart_play_console_reviews", "mart_appstore_reviews"),
        "date",
        "platform",
    ),
}


def needed(names: Sequence[str] | None) -> list[str]:
    """The tables asked for and all that they read, inputs first."""
    if names is None:
        return list(TABLES)
    wanted = set(names)
    for name in reversed(TABLES):
        if name in wanted:
            wanted |= {i for i in TABLES[name].inputs if i in TABLES}
    return [n for n in TABLES if n in wanted]
