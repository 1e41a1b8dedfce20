"""Aggregates that keep their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_partition_total(
    df: DataFrame, value: str, by: Sequence[str], name: str
) -> DataFrame:
    """Adds the total of ``value`` over each ``by`` group to every row of the group.

    Meant for aggregated input: a group is sorted in one task.
    """
    return df.withColumn(name, F.sum(value).over(Window.partitionBy(*by)))
