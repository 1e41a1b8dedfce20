"""Date ranges: request windows, month lists, cuts and lags."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Longest statistics window, and the lag at which vendor reports settle.
STATS_WINDOW_DAYS = 30
LAG_FROM_DAYS = 4
LAG_TO_DAYS = 3


def date_windows(
    spark: SparkSession, date_from: date, date_to: date, days: int = STATS_WINDOW_DAYS
) -> DataFrame:
    """Consecutive windows of at most ``days`` days that cover the range, ends included."""
    if date_from > date_to:
        return spark.createDataFrame([], "window_start date, window_end date")
    step = F.make_dt_interval(F.lit(days))
    span = spark.range(1).select(
        F.explode(F.sequence(F.lit(date_from), F.lit(date_to), step)).alias("window_start")
    )
    return span.select(
        "window_start",
        F.least(F.date_add("window_start", days - 1), F.lit(date_to)).alias("window_end"),
    )


def bucket_by_window(
    df: DataFrame, day: str, date_from: date, date_to: date, days: int = STATS_WINDOW_DAYS
) -> DataFrame:
    """Rows of the range with the window they fall in, by arithmetic instead of a range join."""
    offset = F.datediff(F.col(day), F.lit(date_from))
    start = F.date_add(F.lit(date_from), (F.floor(offset / days) * days).cast("int"))
    return (
        df.filter(in_date_range(day, date_from, date_to))
        .withColumn("window_start", start)
        .withColumn(
            "window_end", F.least(F.date_add("window_start", days - 1), F.lit(date_to))
        )
    )


def in_date_range(day: str | Column, date_from: date | str, date_to: date | str) -> Column:
    """Both ends included. ISO text compares like dates, so raw text columns work too."""
    c = F.col(day) if isinstance(day, str) else day
    return c.between(F.lit(date_from), F.lit(date_to))


def half_open(moment: str, date_from: date, date_to: date) -> Column:
    """Timestamps of the days ``date_from`` .. ``date_to``, written with an exclusive end."""
    c = F.col(moment)
    end = date_to + timedelta(days=1)
    return (c >= F.lit(date_from).cast("timestamp")) & (c < F.lit(end).cast("timestamp"))


def since(created: str, date_from: date | str) -> Column:
    """Incremental cut on a text timestamp: its date part is not before ``date_from``."""
    return F.substring(F.col(created), 1, 10) >= F.lit(str(date_from))


def lagged_window(
    as_of: date, lag_from: int = LAG_FROM_DAYS, lag_to: int = LAG_TO_DAYS
) -> tuple[date, date]:
    """Default extract window: the days four and three days back."""
    return as_of - timedelta(days=lag_from), as_of - timedelta(days=lag_to)


def months_between_dates(spark: SparkSession, date_from: date, date_to: date) -> DataFrame:
    """The months (``yyyyMM``) that a range touches."""
    first, last = date_from.replace(day=1), date_to.replace(day=1)
    if first > last:
        return spark.createDataFrame([], "month string")
    days = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month")))
    return spark.range(1).select(days.alias("day")).select(
        F.date_format("day", "yyyyMM").alias("month")
    )
