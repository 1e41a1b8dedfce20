"""Payload files: what the vendors' APIs answer, stored as JSON, and how it is parsed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appkpi.operators.date_windows import since
from appkpi.sources.flatten import (
    LOAD_COLUMNS,
    flatten_android_reviews,
    flatten_campaign_stats,
    flatten_ios_reviews,
    flatten_metric_rows,
    key_columns,
    merged_names,
)


@dataclass(frozen=True)
class MetricSet:
    name: str
    table: str
    metrics: tuple[str, ...]
    dimensions: tuple[str, ...]


def _rate_set(name: str, table: str, rate: str, extra: tuple[str, ...] = ()) -> MetricSet:
    """A rate comes as the day's value and as 7- and 28-day user-weighted averages."""
    averages = tuple(f"{rate}{days}dUserWeighted" for days in (7, 28))
    return MetricSet(
        name,
        table,
        (rate, *averages),
        ("versionCode", *extra, "deviceModel", "apiLevel", "countryCode"),
    )


# Metric sets of the Android reporting API and the raw tables they land in.
METRIC_SETS = (
    _rate_set("crashRateMetricSet", "raw_crash_rate", "crashRate"),
    _rate_set("anrRateMetricSet", "raw_anr_rate", "anrRate"),
    _rate_set(
        "stuckBackgroundWakelockRateMetricSet",
        "raw_stuck_bg_wakelock_rate",
        "stuckBgWakelockRate",
    ),
    _rate_set(
        "excessiveWakeupRateMetricSet", "raw_excessive_wakeup_rate", "excessiveWakeupRate"
    ),
    MetricSet(
        "errorCountMetricSet",
        "raw_error_count",
        ("errorReportCount", "distinctUsers"),
        ("reportType", "versionCode", "deviceModel", "apiLevel"),
    ),
    _rate_set("slowStartRateMetricSet", "raw_slow_start_rate", "slowStartRate", ("startType",)),
)

# Payload schemas. Every leaf is text; objects that are kept whole are text as well.
METRIC_ROW = """struct<
    aggregationPeriod: string,
    startTime: struct<year: string, month: string, day: string>,
    dimensions: array<struct<dimension: string, stringValue: string, int64Value: string>>,
    metrics: array<struct<
        metric: string,
        decimalValue: struct<value: string>,
        decimalValueConfidenceInterval: struct<
            lowerBound: struct<value: string>, upperBound: struct<value: string>>>>>
"""
ANDROID_REVIEW = """struct<
    reviewId: string,
    authorName: string,
    comments: array<struct<
        userComment: struct<
            text: string, lastModified: struct<seconds: string>, starRating: string,
            reviewerLanguage: string, device: string, androidOsVersion: string,
            appVersionCode: string, appVersionName: string,
            deviceMetadata: struct<
                productName: string, manufacturer: string, deviceClass: string, ramMb: string>>,
        developerComment: struct<text: string, lastModified: struct<seconds: string>>>>>
"""
IOS_REVIEW = """struct<
    id: string,
    attributes: struct<
        rating: string, title: string, body: string, reviewerNickname: string,
        createdDate: string, territory: string>>
"""
CAMPAIGN_STATS_ENTRY = """struct<
    platforms: map<string, struct<locales: map<string, struct<variations: map<string, struct<
        performance_stats: map<string, string>,
        delivery_funnel: string,
        conversion_goal_stats: string>>>>>>>
"""


# Campaign keys that staging reads.
CAMPAIGN_COLUMNS = (
    "campaign_id",
    "channel",
    "status",
    "campaign_delivery_type",
    "created_at",
    "sent_time",
    "basic_details",
    "segmentation_details",
    "conversion_goal_details",
)


def _rows_of(spark: SparkSession, paths: str | Sequence[str], key: str, schema: str) -> DataFrame:
    """The objects listed under ``key`` of one response per file."""
    responses = spark.read.json(paths, schema=f"`{key}` array<{schema}>", multiLine=True)
    return responses.select(F.explode(key).alias("__row")).select("__row.*")


def read_metric_responses(
    spark: SparkSession, paths: str | Sequence[str], metric_set: MetricSet
) -> DataFrame:
    rows = _rows_of(spark, paths, "rows", METRIC_ROW)
    return flatten_metric_rows(
        rows, metric_set.name, metric_set.dimensions, metric_set.metrics
    )


def read_android_review_responses(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return flatten_android_reviews(_rows_of(spark, paths, "reviews", ANDROID_REVIEW))


def read_ios_review_responses(
    spark: SparkSession, paths: str | Sequence[str], date_from: date | None = None
) -> DataFrame:
    """Reviews, cut to those created on or after ``date_from``."""
    reviews = flatten_ios_reviews(_rows_of(spark, paths, "data", IOS_REVIEW))
    return reviews if date_from is None else reviews.filter(since("created_date", date_from))


def read_campaign_stats_responses(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Statistics keyed by campaign; the value is one entry or a list of them."""
    responses = spark.read.json(paths, schema="data map<string, string>", multiLine=True)
    return flatten_campaign_stats(
        parse_campaign_stats(responses.select(F.explode("data").alias("campaign_id", "entry")))
    )


def parse_campaign_stats(entries: DataFrame) -> DataFrame:
    """(campaign_id, entry text) to (campaign_id, stats struct), one row per entry."""
    is_list = F.ltrim(F.col("entry")).startswith("[")
    parsed = F.when(is_list, F.from_json("entry", f"array<{CAMPAIGN_STATS_ENTRY}>")).otherwise(
        F.array(F.from_json("entry", CAMPAIGN_STATS_ENTRY))
    )
    return entries.select("campaign_id", F.explode(parsed).alias("stats"))


def read_campaign_list(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Campaign search answers: a bare list per file.

    A file is one row before it is taken apart: its size is bounded by the vendor's page size.
    """
    return parse_campaign_list(spark.read.text(paths, wholetext=True), columns)


def parse_campaign_list(answers: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Answer texts (``value``) to campaigns. An answer that is no list is left out.

    Without ``columns`` every key becomes a column, after those staging reads; an extra pass
    finds their names. Keys that differ in case are one column, and a key called like a load column
    lands as ``campaign_`` and its name.
    """
    campaigns = answers.filter(F.ltrim("value").startswith("[")).select(
        F.explode(F.from_json("value", "array<map<string, string>>")).alias("c")
    )
    if columns is None:
        names = campaigns.select(F.explode(F.map_keys("c")).alias("name")).distinct()
        found = [r["name"] for r in names.collect()]
        merged = merged_names(found, CAMPAIGN_COLUMNS, LOAD_COLUMNS, "campaign_")
    else:
        merged = {k: [k] for k in columns}
    return campaigns.select(*key_columns("c", merged))
