"""The landing jobs of each vendor's report files, for :func:`appkpi.sources.landing.land_many`.

Files are expected where a download step puts them, under one folder::

    attribution/<report>/<app id>*.csv
    campaigns/list/*.json
    campaigns/stats/<from>_<to>/*.json         one folder per request window
    android/<metric set>/*.json
    android/reviews/*.json
    android/stats/{installs,crashes,store_performance}/*.csv
    ios/reviews/*.json
    ios/<raw table>/*.gz

A job reads one report and appends it to its raw table; jobs are independent, and a missing
report fails its own job only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from appkpi.operators.date_windows import STATS_WINDOW_DAYS
from appkpi.sources.landing import Load, land, read_csv_report, read_tsv_report
from appkpi.sources.monthly import MONTHLY_REPORTS, MONTHLY_SOURCE, read_monthly_stats
from appkpi.sources.payloads import (
    METRIC_SETS,
    read_android_review_responses,
    read_campaign_list,
    read_campaign_stats_responses,
    read_ios_review_responses,
    read_metric_responses,
)

Job = tuple[str, Callable[[], int]]

# Report folders, raw tables, source names.
ATTRIBUTION_REPORTS = {
    "installs": "raw_installs",
    "master_agg": "raw_campaign_performance",
    "in_app_events": "raw_in_app_events",
    "blocked_installs": "raw_blocked_installs",
}
IOS_REPORTS = (
    "raw_app_downloads",
    "raw_app_installs_deletions",
    "raw_app_sessions",
    "raw_app_discovery_engagement",
    "raw_app_install_performance",
)


@dataclass(frozen=True)
class Landing:
    """Where files are read and raw tables written, and the days the files are about."""

    spark: SparkSession
    files: str
    raw: str
    date_from: date
    date_to: date

    def job(
        self,
        name: str,
        table: str,
        source: str,
        read: Callable[[], DataFrame | None],
        first: date | None = None,
        last: date | None = None,
        app_id: str = "",
        platform: str = "",
    ) -> Job:
        def run() -> int:
            df = read()
            if df is None:
                return 0
            load = Load(
                source, first or self.date_from, last or self.date_to, app_id, platform
            )
            return land(df, f"{self.raw}/{table}", load)

        return name, run


def attribution_jobs(at: Landing, apps: Sequence[tuple[str, str]]) -> list[Job]:
    """Every report of every (app id, platform)."""

    def job(report: str, table: str, app_id: str, platform: str) -> Job:
        path = f"{at.files}/attribution/{report}/{app_id}*.csv"
        return at.job(
            f"{report} {platform}",
            f"appsflyer_raw/{table}",
            "appsflyer",
            lambda: read_csv_report(at.spark, path),
            app_id=app_id,
            platform=platform,
        )

    return [
        job(report, table, app_id, platform)
        for app_id, platform in apps
        for report, table in ATTRIBUTION_REPORTS.items()
    ]


def stats_windows(date_from: date, date_to: date) -> list[tuple[date, date]]:
    """The request windows of a range, at most 30 days each, ends included."""
    starts = range(0, (date_to - date_from).days + 1, STATS_WINDOW_DAYS)
    return [
        (
            date_from + timedelta(days=n),
            min(date_from + timedelta(days=n + STATS_WINDOW_DAYS - 1), date_to),
        )
        for n in starts
    ]


def campaign_jobs(at: Landing) -> list[Job]:
    """The campaign list, and the statistics of each request window with its own dates."""

    def window(first: date, last: date) -> Job:
        path = f"{at.files}/campaigns/stats/{first}_{last}"
        return at.job(
            f"campaign stats {first}..{last}",
            "moengage_raw/raw_campaign_stats",
            "moengage",
            lambda: read_campaign_stats_responses(at.spark, path),
            first,
            last,
        )

    listed = at.job(
        "campaigns",
        "moengage_raw/raw_campaigns",
        "moengage",
        lambda: read_campaign_list(at.spark, f"{at.files}/campaigns/list"),
    )
    return [listed, *[window(*w) for w in stats_windows(at.date_from, at.date_to)]]


def android_jobs(at: Landing, package: str) -> list[Job]:
    """Metric sets, reviews and the monthly files of one package."""
    root = f"{at.files}/android"

    def metrics(metric_set) -> Job:
        return at.job(
            metric_set.name,
            f"play_raw/{metric_set.table}",
            "play_console",
            lambda: read_metric_responses(at.spark, f"{root}/{metric_set.name}", metric_set),
        )

    def monthly(folder: str, suffix: str, table: str) -> Job:
        return at.job(
            table,
            f"play_raw/{table}",
            MONTHLY_SOURCE,
            lambda: read_monthly_stats(
                at.spark, f"{root}/{folder}", suffix, package, at.date_from, at.date_to
            ),
        )

    reviews = at.job(
        "android reviews",
        "play_raw/raw_reviews",
        "play_console",
        lambda: read_android_review_responses(at.spark, f"{root}/reviews"),
    )
    return [
        *[metrics(m) for m in METRIC_SETS],
        reviews,
        *[monthly(*report) for report in MONTHLY_REPORTS],
    ]


def ios_jobs(at: Landing) -> list[Job]:
    """Reviews since the first day, and the report segments, whose headers may differ."""

    def report(table: str) -> Job:
        path = f"{at.files}/ios/{table}"
        return at.job(
            table,
            f"appstore_raw/{table}",
            "app_store",
            lambda: read_tsv_report(at.spark, path, mixed_headers=True),
        )

    reviews = at.job(
        "ios reviews",
        "appstore_raw/raw_reviews",
        "app_store",
        lambda: read_ios_review_responses(at.spark, f"{at.files}/ios/reviews", at.date_from),
    )
    return [reviews, *[report(t) for t in IOS_REPORTS]]
