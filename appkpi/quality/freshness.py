"""How old the newest load of a raw table is."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appkpi.sources.files import folder_names
from appkpi.sources.landing import INGEST_DAY


@dataclass(frozen=True)
class Freshness:
    warn_hours: int
    error_hours: int


def newest_loads(spark: SparkSession, path: str) -> DataFrame:
    """The newest load day of a raw table stored by day, from the names of its folders.

    Only that day's files are opened. A table without such folders is read as it is.
    """
    prefix = f"{INGEST_DAY}="
    days = [n for n in folder_names(spark, path) if n.startswith(prefix) and n[len(prefix) :][:1].isdigit()]
    return spark.read.parquet(f"{path}/{max(days)}" if days else path)


def freshness_report(
    tables: Mapping[str, DataFrame], rules: Mapping[str, Freshness], as_of: datetime
) -> DataFrame:
    """Newest load, its age in hours and a status per table. Never loaded counts as an error.

    Give :func:`newest_loads` of stored tables, whose older days then stay unread.
    """

    def one(name: str) -> DataFrame:
        rule = rules[name]
        newest = tables[name].agg(F.max("_ingested_at").cast("timestamp").alias("newest_load"))
        age = (
            F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("newest_load")
        ) / 3_600_000_000
        return newest.withColumn("age_hours", age).select(
            F.lit(name).alias("table"),
            "newest_load",
            "age_hours",
            F.when(F.col("newest_load").isNull() | (F.col("age_hours") > rule.error_hours), "error")
            .when(F.col("age_hours") > rule.warn_hours, "warn")
            .otherwise("pass")
            .alias("status"),
        )

    return reduce(lambda a, b: a.unionByName(b), [one(n) for n in tables])
