"""Tables refreshed load by load equal those built from everything, and leave other days alone."""

from __future__ import annotations

import os
from datetime import date
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from appkpi.plans import incremental
from appkpi.plans.build import table
from appkpi.plans.catalog import raw_name
from appkpi.plans.contracts import CONTRACTS
from appkpi.plans.incremental import Days, needed, refresh_new_loads
from appkpi.sources.landing import INGEST_DAY
from workloads.raw_shapes import RawTables

SF_DIR = "/root/testdata/sf0.001"


def raw_path(root, name):
    return f"{root}/{raw_name(name).replace('.', '/')}"


def append(rows, root, name, load):
    """A load of its own day; rows keep the numbers that settle ties."""
    stamped = rows.withColumns({
        "_ingested_at": F.to_timestamp(F.lit(f"2026-07-{10 + load} 05:00:00")), "_run_id": F.lit(f"run-{load}")
    })
    stamped.withColumn(INGEST_DAY, F.to_date("_ingested_at")).write.mode("append").partitionBy(INGEST_DAY).parquet(
        raw_path(root, name)
    )


def same_rows(a, b):
    """The tables' rows, doubles to ten digits."""
    def rounded(df):
        return df.select(*[
            F.round(c, 10).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)
        ])

    a, b = rounded(a), rounded(b)
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def files_of(path):
    return {str(p): os.stat(p).st_mtime_ns for p in Path(path).rglob("*.parquet")}


def inputs_of(names):
    return [n for n in needed(names) if n in CONTRACTS]


def full(spark, root, name):
    raw = {raw_name(n): spark.read.parquet(raw_path(root, n)).drop(INGEST_DAY) for n in inputs_of([name])}
    return table(name, raw, spark)


@pytest.mark.parametrize("names", [["mart_appsflyer_retention", "mart_appsflyer_fraud"], ["mart_moengage_push"]])
def test_three_loads_equal_a_full_refresh(spark, tmp_path, names):
    raw, tables = f"{tmp_path}/raw", f"{tmp_path}/tables"
    generated = RawTables(spark, SF_DIR)
    for load in range(3):
        for name in inputs_of(names):
            rows = generated[raw_name(name)]
            # Later loads hold other rows and new versions of some of the former's.
            part = F.pmod(F.xxhash64(*rows.columns), F.lit(5))
            append(rows.where(part.isin([load, 3])), raw, name, load)
        found, changed = refresh_new_loads(spark, raw, tables, names)
        assert all(changed[n] for n in names)
    for name in names:
        assert same_rows(found[name], full(spark, raw, name)), name
    before = files_of(tables)
    _, changed = refresh_new_loads(spark, raw, tables, names)
    assert changed == {} and files_of(tables) == before


PERFORMANCE = "stg_appsflyer_campaign_performance"
MART = "mart_appsflyer_campaign_performance"


@pytest.fixture
def campaign_columns():
    sources = {f[0]: f[2] if len(f) > 2 else f[0] for f in CONTRACTS[PERFORMANCE].fields}
    return {"day": sources["date"], "clicks": sources["clicks"], "campaign": sources["campaign"]}


def test_untouched_days_are_neither_read_nor_written(spark, raw, tmp_path, campaign_columns):
    root, tables = f"{tmp_path}/raw", f"{tmp_path}/tables"
    c = campaign_columns

    def load(number, rows):
        append(raw([{c["day"]: d, c["campaign"]: x, c["clicks"]: str(n)} for d, x, n in rows]), root, PERFORMANCE, number)
        return refresh_new_loads(spark, root, tables, [MART])

    load(0, [("2026-06-01", "a", 1), ("2026-06-02", "a", 2), ("2026-06-03", "a", 3)])
    before = files_of(tables)
    found, changed = load(1, [("2026-06-02", "a", 20), ("2026-06-04", "b", 4)])
    assert changed == {n: Days({date(2026, 6, 2), date(2026, 6, 4)}) for n in (PERFORMANCE, MART)}
    after = files_of(tables)
    for name in (PERFORMANCE, MART):
        kept = {p for p in before if f"/{name}/" in p and "date=2026-06-02" not in p}
        assert kept and all(after.get(p) == before[p] for p in kept)
        assert {p.split("date=")[1][:10] for p in after if f"/tables/{name}/" in p} == {f"2026-06-0{k}" for k in (1, 2, 3, 4)}
    assert {(r.date.day, r.clicks) for r in found[MART].collect()} == {(1, 1), (2, 20), (3, 3), (4, 4)}
    # What a refresh of one day reads: one folder.
    cut = found[PERFORMANCE].filter(Days({date(2026, 6, 2)}).test("date"))
    assert "date" in plan_of(cut).split("PartitionFilters: [")[1].split("]")[0]
    # Only the newest loads' folders are looked at.
    rows, loads = incremental.new_loads(spark, raw_path(root, PERFORMANCE), f"{tables}/_done/{PERFORMANCE}", late_days=0)
    assert loads is None and f"({INGEST_DAY}#" in plan_of(rows) and ">= 2026-07-11" in plan_of(rows)


def test_a_run_that_stopped_is_repeated(spark, raw, tmp_path, campaign_columns, monkeypatch):
    root, tables = f"{tmp_path}/raw", f"{tmp_path}/tables"
    c = campaign_columns
    for number, clicks in enumerate((1, 2)):
        rows = [{c["day"]: d, c["campaign"]: "a", c["clicks"]: str(clicks)} for d in ("2026-06-01", "rubbish", "")]
        append(raw(rows), root, PERFORMANCE, number)
        with monkeypatch.context() as m:
            m.setattr(incremental, "rebuild", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                refresh_new_loads(spark, root, tables, [MART])
        found, changed = refresh_new_loads(spark, root, tables, [MART])
        # Rows without a day have a folder of their own.
        assert None in changed[PERFORMANCE].days
        assert {(r.date and r.date.day, r.clicks) for r in found[MART].collect()} == {(1, clicks), (None, clicks)}
    assert not list(Path(f"{tables}/_staged").iterdir())


def test_late_loads_and_missing_tables(spark, raw, tmp_path, campaign_columns):
    root, tables = f"{tmp_path}/raw", f"{tmp_path}/tables"
    c = campaign_columns
    assert refresh_new_loads(spark, root, tables, [MART])[1] == {}
    for number in (5, 4):
        append(raw([{c["day"]: "2026-06-01", c["campaign"]: f"c{number}", c["clicks"]: "1"}]), root, PERFORMANCE, number)
        found, _ = refresh_new_loads(spark, root, tables, [MART])
    assert found[MART].count() == 2


def test_days_of_retention_reach_back():
    opened = {"stg_appsflyer_in_app_events": Days({date(2026, 6, 30)})}
    assert incremental.changed_days("mart_appsflyer_retention", opened).days == {
        date(2026, 6, 29), date(2026, 6, 23), date(2026, 5, 31)
    }
    assert incremental.changed_days("mart_moengage_push", {"stg_moengage_campaigns": Days(all=True)}).all
    assert not incremental.changed_days("mart_moengage_push", {})
