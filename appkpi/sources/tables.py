"""Writing and reading tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from appkpi.operators.date_windows import in_date_range
from appkpi.sources.landing import INGEST_DAY, STREAM_BATCH


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """A table that is recomputed wherever it is read."""
    df.createOrReplaceTempView(name)
    return df


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
) -> None:
    """Full refresh of a Parquet table: a folder per day, rows sorted by the cluster columns.

    Rows are rebalanced on the partition column: adaptive execution packs small days into
    one task and splits a day that holds much of the data over several, which a plain
    ``repartition(day)`` would send to a single one.
    """
    order = [c for c in cluster_by if c != partition_by]
    if partition_by:
        laid_out = df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *order)
        laid_out.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        laid_out = df.hint("rebalance")
        if order:
            laid_out = laid_out.sortWithinPartitions(*order)
        laid_out.write.mode("overwrite").parquet(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    partition_by: str | None = None,
    date_from: date | None = None,
    date_to: date | None = None,
) -> DataFrame:
    """A table, or the days of it that are asked for; other days' folders are not read.

    ``schema`` gives back the column order, which partitioned writing changes.
    """
    df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    if partition_by and date_from is not None and date_to is not None:
        df = df.filter(in_date_range(partition_by, date_from, date_to))
    return df.select(*schema.fieldNames()) if schema else df


def read_raw(
    spark: SparkSession,
    path: str,
    ingested_from: date | None = None,
) -> DataFrame:
    """A raw table without its storage columns, optionally only the loads since a day."""
    df = spark.read.parquet(path)
    if ingested_from is not None:
        df = df.filter(F.col(INGEST_DAY) >= F.lit(ingested_from))
    return df.drop(INGEST_DAY, STREAM_BATCH)
