"""Session settings the library depends on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Dates are cut from timestamps in the session zone, so the zone decides the day a row
# belongs to. Everything here is defined in UTC.
SESSION_ZONE = "UTC"


def get_spark(app_name: str = "appkpi", **conf: str) -> SparkSession:
    """A session for jobs and tests. Cluster settings given by spark-submit stay untouched.

    Shuffle partitions are left to the cluster's own value: adaptive execution coalesces
    them to the advisory size, and splits the skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", SESSION_ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Refuse to run where days would be cut in another zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "+00:00", "Z"):
        raise ValueError(f"spark.sql.session.timeZone is {zone!r}; the KPI tables are defined in UTC")
