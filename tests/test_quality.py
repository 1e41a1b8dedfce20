from collections import Counter
from datetime import UTC, datetime

import pytest
from conftest import as_dicts, at, day, plan_of

from appkpi.plans.catalog import TABLES
from appkpi.quality import (
    Freshness,
    accepted_range,
    accepted_values,
    freshness_report,
    is_true,
    not_null,
    quality_report,
    raise_on_errors,
    unique,
)
from appkpi.quality.freshness import newest_loads
from appkpi.quality.expectations import EXPECTATIONS, FRESHNESS

ROWS = [("a", 1, "x"), ("a", 6, "y"), (None, None, None), (None, 0, "z"), ("b", 5, "x")]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "k string, n int, v string")


def failures(df, *checks):
    return [r["failures"] for r in quality_report(df, "t", checks).collect()]


def test_null_passes_everything_but_not_null(df):
    assert failures(df, not_null("k"), accepted_values("v", ["x", "y"]),
                    accepted_range("n", low=1, high=5),
                    accepted_range("n", low=0, inclusive=False),
                    accepted_range("n", high=5, inclusive=False),
                    is_true("n", ">= 1")) == [2, 1, 2, 1, 2, 1]


def test_uniqueness(spark, df):
    assert failures(df, unique("k")) == [1]
    pairs = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "k string, n int")
    assert failures(pairs, unique("k", "n")) == [1]  # NULL counts as a value here
    assert failures(pairs, unique("n")) == [0]


def test_row_tests_are_one_scan(df):
    report = quality_report(df, "t", [not_null("k"), not_null("n"), accepted_range("n", low=0)])
    plan = plan_of(report)
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Exchange") == 1


def test_report_and_severity(df):
    report = quality_report(df, "t", [not_null("k"), not_null("n").warn(), accepted_range("n", low=0)])
    rows = as_dicts(report, "test", "columns")
    assert [(r["test"], r["columns"], r["severity"], r["status"]) for r in rows] == [
        ("accepted_range", "n", "error", "pass"), ("not_null", "k", "error", "fail"),
        ("not_null", "n", "warn", "warn"),
    ]
    with pytest.raises(RuntimeError, match="t.k not_null: 2"):
        raise_on_errors(report)
    raise_on_errors(quality_report(df, "t", [not_null("n").warn()]))


def test_expectations_cover_known_tables_and_columns():
    checks = [c for cs in EXPECTATIONS.values() for c in cs]
    assert set(EXPECTATIONS) <= set(TABLES)
    assert Counter(c.kind for c in checks) == {
        "not_null": 85, "accepted_range": 51, "accepted_values": 11, "unique": 10,
        "expression_is_true": 4, "unique_combination": 1,
    }
    assert sum(c.severity == "warn" for c in checks) == 57
    assert len(FRESHNESS) == 23


def test_freshness_reads_the_newest_day_only(spark, folder):
    loads = [(at(9, 5), day(9)), (at(8), day(8)), (at(9, 7), day(9)), (at(1), None)]
    rows = spark.createDataFrame(loads, "_ingested_at timestamp, _ingest_date date")
    rows.write.partitionBy("_ingest_date").parquet(folder)
    newest = newest_loads(spark, folder)
    assert newest.inputFiles() and all("_ingest_date=2026-06-09" in f for f in newest.inputFiles())
    report = freshness_report({"t": newest}, {"t": Freshness(25, 49)}, datetime(2026, 6, 9, 8, tzinfo=UTC))
    assert report.first()["age_hours"] == 1.0


def test_freshness(spark):
    rules = {n: Freshness(25, 49) for n in ("new", "late", "old", "never", "edge")}
    newest = {"new": at(10), "late": at(9), "old": at(8), "edge": datetime(2026, 6, 9, 9, tzinfo=UTC)}
    tables = {
        n: spark.createDataFrame(
            [(newest[n],), (at(1),)] if n in newest else [], "_ingested_at timestamp"
        )
        for n in rules
    }
    report = freshness_report(tables, rules, datetime(2026, 6, 10, 10, tzinfo=UTC))
    assert {r["table"]: (r["age_hours"], r["status"]) for r in report.collect()} == {
        "new": (10.0, "pass"), "late": (34.0, "warn"), "old": (58.0, "error"),
        "never": (None, "error"), "edge": (25.0, "pass"),
    }
