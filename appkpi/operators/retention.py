"""Cohort retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OFFSETS = (1, 7, 30)


def cohort_retention(
    cohort: DataFrame,
    activity: DataFrame,
    user: str,
    cohort_date: str,
    activity_date: str,
    by: Sequence[str],
    offsets: Sequence[int] = OFFSETS,
) -> DataFrame:
    """Cohort size, users back after exactly n days, and their share, per cohort group.

    ``cohort`` holds one row per user, cohort date and ``by`` values. Instead of joining
    users with all their active days and testing the date afterwards, every cohort row is
    repeated for the few days that count and joined on (user, day): the join output is
    bounded by ``len(offsets)`` rows per cohort row however active a user is, and a very
    active user's days spread over the tasks. Activity is de-duplicated map-side first, so
    each probe finds at most one row and the two levels of aggregation fold into one.
    """
    group = [cohort_date, *by]
    active = (
        activity.selectExpr(f"`{user}` AS __user", f"`{activity_date}` AS __day")
        .filter("__user IS NOT NULL AND __day IS NOT NULL")
        .distinct()
        .selectExpr("*", "TRUE AS __seen")
    )
    days = ", ".join(str(n) for n in offsets)
    probes = cohort.selectExpr(
        f"`{user}` AS __user", *[f"`{g}`" for g in group], f"explode(array({days})) AS __offset"
    ).selectExpr("*", f"date_add(`{cohort_date}`, __offset) AS __day")

    def retained(n: int) -> str:
        return f"count_if(__offset = {n} AND __seen) AS retained_d{n}"

    counted = (
        probes.join(active, on=["__user", "__day"], how="left")
        .groupBy(*group)
        .agg(
            F.expr(f"count_if(__offset = {offsets[0]}) AS cohort_size"),
            *[F.expr(retained(n)) for n in offsets],
        )
    )
    return counted.selectExpr(
        *[f"`{g}`" for g in group],
        "cohort_size",
        *[f"retained_d{n}" for n in offsets],
        *[f"try_divide(retained_d{n}, nullif(cohort_size, 0)) AS d{n}_retention" for n in offsets],
    )
