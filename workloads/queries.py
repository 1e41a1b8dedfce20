"""The registered queries: every table, and every operator on its own."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from appkpi.plans.build import table
from appkpi.plans.catalog import TABLES
from appkpi.session import SESSION_ZONE
from workloads import operator_queries
from workloads.oracle_tables import table_sql
from workloads.raw_shapes import RawTables

# A byte of the tables becomes some thirty bytes of text rows, which a task sorts in memory before
# it sends on the latest of each key. With Spark's 128 MB a part, such sorts spill.
SPLIT_BYTES = "8m"

Query = Callable[[SparkSession, str], DataFrame]


def zone_free(df: DataFrame) -> DataFrame:
    """UTC timestamps as zone-free ones, the type of the generated tables."""
    moments = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({m: F.col(m).cast("timestamp_ntz") for m in moments})


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return zone_free(table(name, RawTables(spark, sf_dir), spark))


def _in_utc(query: Query) -> Query:
    """The query in a session that cuts days in UTC and input into small parts, whatever the cluster starts with."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
        spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    name: _in_utc(query)
    for name, query in {
        **operator_queries.QUERIES,
        **{name: partial(_table, name=name) for name in TABLES},
    }.items()
}
ORACLE: dict[str, str] = {
    **operator_queries.ORACLE,
    **{name: table_sql(name) for name in TABLES},
}
