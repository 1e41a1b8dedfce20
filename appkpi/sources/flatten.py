"""Nested API payloads to flat text rows, with higher-order functions only.

Each function takes parsed payload rows (see ``payloads`` for their schemas) and returns
all-text columns. What a payload does not carry becomes ``''``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appkpi.operators.latest import LANDED_ROW
from appkpi.sources.landing import INGEST_DAY, METADATA, STREAM_BATCH

# Statistics fields that staging reads. Landing keeps whatever else there is.
CAMPAIGN_STATS = (
    "sent",
    "impression",
    "click",
    "ctr",
    "attempted",
    "failed",
    "device_start",
    "delivery_rate",
    "sent_rate",
    "failure_rate",
)


LEAF_COLUMNS = (
    "campaign_id",
    "platform",
    "locale",
    "variation",
    "delivery_funnel",
    "conversion_goal_stats",
)
# What landing adds to every row, and how it stores them.
LOAD_COLUMNS = (*METADATA, INGEST_DAY, STREAM_BATCH, LANDED_ROW)


def merged_names(
    found: Sequence[str], known: Sequence[str], taken: Sequence[str], prefix: str
) -> dict[str, list[str]]:
    """Columns for the keys ``found`` in answers, each with the spellings it is read from.

    Spellings that differ in case are one column, as column names are: it is called as in ``known``, else
    by the first spelling in order. Of a row that has several the first with a value counts, in the same order. A
    key called like a column that is there already (``taken``) lands as ``prefix`` and its name.
    """
    known_as = {k.lower(): k for k in known}
    spellings: dict[str, list[str]] = {k.lower(): [k] for k in known}
    for name in sorted(set(found)):
        own = spellings.setdefault(name.lower(), [])
        if name not in own:
            own.append(name)
    used = {x.lower() for x in taken}
    columns: dict[str, list[str]] = {}
    for low, own in spellings.items():
        name = known_as.get(low, own[0])
        while name.lower() in used or (name != known_as.get(low) and name.lower() in spellings and name.lower() != low):
            name = prefix + name
        used.add(name.lower())
        columns[name] = own
    return columns


def key_columns(keys: str, columns: dict[str, list[str]]) -> list[Column]:
    """The columns of :func:`merged_names` from a map of texts; ``''`` where no spelling has a value."""
    return [
        F.coalesce(*[F.try_element_at(keys, F.lit(s)) for s in own], F.lit("")).alias(name)
        for name, own in columns.items()
    ]


def _text(c: Column | str) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def _last_where(array: str, test) -> Column:
    """Last element that passes; NULL if none does. Later entries win, as in the source."""
    return F.try_element_at(F.filter(F.col(array), test), F.lit(-1))


def _last_called(array: str, field: str, name: str) -> Column:
    return _last_where(array, lambda entry: entry[field] == name)


def flatten_metric_rows(
    rows: DataFrame, metric_set: str, dimensions: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """Metric-set rows: one column per dimension, per metric and per confidence bound."""

    # Each entry is found once, as a column of its own, before its fields are taken.
    entries = rows.select(
        "startTime",
        "aggregationPeriod",
        *[
            _last_called("dimensions", "dimension", n).alias(f"__d{k}")
            for k, n in enumerate(dimensions)
        ],
        *[
            _last_called("metrics", "metric", n).alias(f"__m{k}")
            for k, n in enumerate(metrics)
        ],
    )

    def dimension(k: int, name: str) -> Column:
        return _text(F.coalesce(F.col(f"__d{k}.stringValue"), F.col(f"__d{k}.int64Value"))).alias(name)

    def metric(k: int, name: str) -> list[Column]:
        bounds = F.col(f"__m{k}.decimalValueConfidenceInterval")
        return [
            _text(F.col(f"__m{k}.decimalValue.value")).alias(name),
            _text(bounds["lowerBound"]["value"]).alias(f"{name}_ci_lower"),
            _text(bounds["upperBound"]["value"]).alias(f"{name}_ci_upper"),
        ]

    day = F.concat_ws(
        "-",
        _text("startTime.year"),
        F.lpad(_text("startTime.month"), 2, "0"),
        F.lpad(_text("startTime.day"), 2, "0"),
    )
    return entries.select(
        F.lit(metric_set).alias("metric_set"),
        day.alias("date"),
        _text("aggregationPeriod").alias("aggregation_period"),
        *[dimension(k, d) for k, d in enumerate(dimensions)],
        *[c for k, m in enumerate(metrics) for c in metric(k, m)],
    )


def flatten_android_reviews(reviews: DataFrame) -> DataFrame:
    """Store reviews with the user's last comment and the developer's last reply."""
    with_comments = reviews.select(
        "reviewId",
        "authorName",
        _last_where("comments", lambda c: c["userComment"].isNotNull())["userComment"].alias("u"),
        _last_where("comments", lambda c: c["developerComment"].isNotNull())[
            "developerComment"
        ].alias("r"),
    )
    fields = {
        "review_id": "reviewId",
        "author_name": "authorName",
        "text": "u.text",
        "last_modified_seconds": "u.lastModified.seconds",
        "star_rating": "u.starRating",
        "reviewer_language": "u.reviewerLanguage",
        "device": "u.device",
        "android_os_version": "u.androidOsVersion",
        "app_version_code": "u.appVersionCode",
        "app_version_name": "u.appVersionName",
        "device_product_name": "u.deviceMetadata.productName",
        "device_manufacturer": "u.deviceMetadata.manufacturer",
        "device_class": "u.deviceMetadata.deviceClass",
        "device_ram_mb": "u.deviceMetadata.ramMb",
        "developer_reply_text": "r.text",
        "developer_reply_seconds": "r.lastModified.seconds",
    }
    return with_comments.select(*[_text(path).alias(name) for name, path in fields.items()])


def flatten_ios_reviews(reviews: DataFrame) -> DataFrame:
    fields = {
        "review_id": "id",
        "rating": "attributes.rating",
        "title": "attributes.title",
        "body": "attributes.body",
        "reviewer_nickname": "attributes.reviewerNickname",
        "created_date": "attributes.createdDate",
        "territory": "attributes.territory",
    }
    return reviews.select(*[_text(path).alias(name) for name, path in fields.items()])


def flatten_campaign_stats(
    stats: DataFrame, fields: Sequence[str] | None = None
) -> DataFrame:
    """Platform, locale and variation maps to one row per leaf; no leaf, no row.

    Without ``fields`` every statistic found becomes a column, beside those staging reads; an
    extra pass over the answers finds their names, which are a few dozen. Names that differ in case
    are one column, and a statistic called like a leaf or load column lands as ``stat_`` and its name.
    """
    leaves = (
        stats.select("campaign_id", F.explode("stats.platforms").alias("platform", "p"))
        .select("campaign_id", "platform", F.explode("p.locales").alias("locale", "l"))
        .select(
            "campaign_id", "platform", "locale", F.explode("l.variations").alias("variation", "v")
        )
    )
    if fields is None:
        names = leaves.select(F.explode(F.map_keys("v.performance_stats")).alias("name"))
        found = [r["name"] for r in names.distinct().collect()]
        columns = merged_names(found, CAMPAIGN_STATS, (*LEAF_COLUMNS, *LOAD_COLUMNS), "stat_")
    else:
        columns = {f: [f] for f in fields}
    return leaves.select(
        "campaign_id",
        "platform",
        "locale",
        "variation",
        *key_columns("v.performance_stats", columns),
        F.coalesce("v.delivery_funnel", F.lit("{}")).alias("delivery_funnel"),
        F.coalesce("v.conversion_goal_stats", F.lit("{}")).alias("conversion_goal_stats"),
    )
