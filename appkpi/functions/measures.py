"""Aggregate building blocks used by the KPI tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division; a zero or missing denominator gives NULL. Never capped at 1."""
    return F.try_divide(_col(numerator), F.nullif(_col(denominator), F.lit(0)))


def sum_where(condition: Column, value: Column | str) -> Column:
    """Sum of ``value`` where ``condition`` holds, other rows counting as 0."""
    return F.sum(F.when(condition, _col(value)).otherwise(F.lit(0)))


def count_where(condition: Column) -> Column:
    """Number of rows where ``condition`` is true; NULL does not count."""
    return F.count_if(condition)


def zero_if_missing(c: Column | str) -> Column:
    """NULL to 0, as a bigint or double like the input."""
    return F.coalesce(_col(c), F.lit(0))
