"""Staging types the values of the rows it keeps; raw run ids are rounded without decimals."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import as_dicts, at, day, plan_of
from pyspark.sql import functions as F

from appkpi.operators.latest import LANDED_ROW, keep_latest
from appkpi.plans.contracts import CONTRACTS
from appkpi.plans.staging import stage
from workloads import raw_shapes

NAME = "stg_play_console_crash_rate"


def crash(rate, **more):
    return {"date": "2026-06-01", "versionCode": "7", "crashRate": rate, "apiLevel": "33", **more}


def numbered(rows):
    return rows.withColumn(LANDED_ROW, F.col("note").cast("bigint"))


def test_numbered_rows_are_typed_after_the_latest_is_known(raw):
    plan = plan_of(stage(numbered(raw([crash("0.5", note="1")])), NAME).select("date", "crash_rate"))
    window = plan.index("Window ")
    assert "RLIKE" in plan[:window] and "crashRate" not in plan[:window]
    assert "AS DOUBLE" not in plan[window:].upper()


def test_the_latest_numbered_row_counts_even_if_its_value_cannot_be_read(raw):
    rows = numbered(raw([
        crash("0.5", note="1", _ingested_at=at(1)),
        crash("1d", note="2", versionCode=" +07 ", _ingested_at=at(2)),
        crash("0.25", note="3", versionCode="8"),
        crash("0.125", note="4", versionCode="0x8"),
        crash("2e0", note="5", versionCode="x"),
        crash("", note="6", versionCode=None, _ingested_at=at(1)),
    ]))
    found = as_dicts(stage(rows, NAME), "version_code")
    assert [(r["date"], r["version_code"], r["crash_rate"]) for r in found] == [
        (day(1), 7, None), (day(1), 8, 0.125), (day(1), None, 2.0),
    ]


@pytest.mark.parametrize("name", sorted(n for n, c in CONTRACTS.items() if c.key))
def test_numbered_rows_have_the_columns_and_types_of_others(raw, name):
    columns = list(dict.fromkeys(f[2] if len(f) > 2 else f[0] for f in CONTRACTS[name].fields))
    rows = raw([], columns)
    plain = stage(rows, name)
    late = stage(rows.withColumn(LANDED_ROW, F.lit(1).cast("bigint")), name)
    assert late.dtypes == plain.dtypes


def test_latest_rows_are_the_same_when_sorted_by_hash(spark):
    rows = [(k, c, at(i % 3 + 1), f"r{i % 5}", i) for i, (k, c) in enumerate([(1, "a"), (None, "a"), (1, None)] * 9)]
    df = spark.createDataFrame(rows, f"k bigint, c string, _ingested_at timestamp, _run_id string, {LANDED_ROW} bigint")
    plain, hashed = (keep_latest(df.repartition(3), ["k", "c"], sort_by_hash=h) for h in (False, True))
    assert hashed.columns == df.columns
    assert as_dicts(hashed) == as_dicts(plain) and hashed.count() == 3


def test_wide_keys_that_readers_do_not_group_on_are_sorted_by_hash(raw):
    rows = raw([], ["date", "download_type", "app_version", "device", "counts"])
    assert "Sort [_w0" in plan_of(stage(rows, "stg_appstore_app_downloads"))
    assert "Sort [_w0" not in plan_of(stage(rows, NAME))


def test_run_ids_round_halves_away_from_zero(spark):
    amounts = [0.0, 0.005, 0.015, 0.025, 0.035, -0.005, -0.025, 1.125, 2.375, -2.125, 34950.23, 0.07, 1e13, None]
    rows = spark.createDataFrame([(a,) for a in amounts], "amount double")
    text = raw_shapes._hundredths("amount")
    assert "rint" in text
    expected = [
        a if a is None else str(int(Decimal(repr(a * 100)).quantize(Decimal(1), ROUND_HALF_UP))) for a in amounts
    ]
    assert [r[0] for r in rows.selectExpr(text).collect()] == expected
