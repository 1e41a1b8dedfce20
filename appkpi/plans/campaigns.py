"""Push-campaign statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appkpi.functions import ratio

ALL_VARIATIONS = "all_variations"
NO_GOAL = "{}"


def _totals(stats: DataFrame, sums: dict[str, str], extra_key: dict[str, Column]) -> DataFrame:
    """Totals per campaign, platform and window.

    Campaigns are unique by id, so grouping before the join gives the groups that grouping
    by campaign attributes after it would, and the join sees one row per group however
    many statistics rows a large campaign has.
    """
    keys = {
        "stats_date_from": F.col("_extract_from"),
        "stats_date_to": F.col("_extract_to"),
        **extra_key,
    }
    return (
        stats.filter(F.col("variation") == ALL_VARIATIONS)
        .withColumns(keys)
        .groupBy("campaign_id", "platform", *keys)
        .agg(*[F.sum(source).alias(name) for name, source in sums.items()])
    )


def _with_campaign(totals: DataFrame, campaigns: DataFrame, columns: Sequence[str]) -> DataFrame:
    attributes = campaigns.withColumnRenamed("status", "campaign_status")
    return totals.join(attributes.select("campaign_id", *columns), "campaign_id", "left")


def push_metrics(stats: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Sent, opened (impressions stand in for opens) and clicked."""
    attributes = ("channel", "campaign_status", "campaign_delivery_type")
    sums = {"sent": "sent", "open_proxy": "impression", "click": "click"}
    rows = _with_campaign(_totals(stats, sums, {}), campaigns, attributes)
    return rows.select(
        "campaign_id",
        *attributes,
        "platform",
        "stats_date_from",
        "stats_date_to",
        *sums,
        ratio("click", "sent").alias("click_rate"),
        ratio("open_proxy", "sent").alias("open_proxy_rate"),
    )


def campaign_analytics(stats: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Push metrics with name, tags, reach, delivery and the goal statistics, if any."""
    attributes = (
        "campaign_name",
        "channel",
        "campaign_status",
        "campaign_delivery_type",
        "segment_tags",
    )
    sums = {
        "target_users": "reachable_users_in_segment",
        "sent": "sent",
        "open_proxy": "impression",
        "click": "click",
        "attempted": "attempted",
        "failed": "failed",
    }
    goal = {
        "conversion_goal_stats_raw": F.nullif("conversion_goal_stats", F.lit(NO_GOAL)),
    }
    rows = _with_campaign(_totals(stats, sums, goal), campaigns, attributes)
    return rows.select(
        "campaign_id",
        *attributes,
        "platform",
        "stats_date_from",
        "stats_date_to",
        *sums,
        ratio("open_proxy", "sent").alias("open_proxy_rate"),
        ratio("click", "sent").alias("click_rate"),
        ratio("sent", "attempted").alias("delivery_rate"),
        "conversion_goal_stats_raw",
    )
