import gzip
import json
from datetime import date

import pytest
from conftest import as_dicts
from test_landing import write

from appkpi.plans.build import table
from appkpi.plans.catalog import RAW_PREFIX
from appkpi.plans.contracts import CONTRACTS
from appkpi.sources import land_many, read_raw
from appkpi.sources.payloads import CAMPAIGN_COLUMNS
from appkpi.sources.vendors import (
    ATTRIBUTION_REPORTS,
    IOS_REPORTS,
    Landing,
    android_jobs,
    attribution_jobs,
    campaign_jobs,
    ios_jobs,
    stats_windows,
)


@pytest.fixture
def at(spark, tmp_path):
    return Landing(
        spark, str(tmp_path / "files"), str(tmp_path / "raw"), date(2026, 6, 1), date(2026, 7, 5)
    )


def raw(at, name):
    return read_raw(at.spark, f"{at.raw}/{name}")


def test_reports_name_the_tables_that_staging_reads():
    read = {c.raw for c in CONTRACTS.values()}
    assert {*ATTRIBUTION_REPORTS.values(), *IOS_REPORTS} < read
    campaign_fields = {f[0] for f in CONTRACTS["stg_moengage_campaigns"].fields}
    assert set(CAMPAIGN_COLUMNS) == campaign_fields
    assert len(RAW_PREFIX) == 4


@pytest.mark.parametrize(
    ("first", "last", "windows"),
    [
        (date(2026, 6, 1), date(2026, 6, 30), [(date(2026, 6, 1), date(2026, 6, 30))]),
        (
            date(2026, 6, 1), date(2026, 7, 1),
            [(date(2026, 6, 1), date(2026, 6, 30)), (date(2026, 7, 1), date(2026, 7, 1))],
        ),
        (date(2026, 6, 2), date(2026, 6, 1), []),
    ],
)
def test_stats_windows(first, last, windows):
    assert stats_windows(first, last) == windows


def test_one_missing_report_fails_alone(spark, tmp_path, at):
    header = "Appsflyer ID,Install Time,Media Source"
    for platform, app in (("android", "app.a"), ("ios", "id1")):
        for report in ATTRIBUTION_REPORTS:
            if (report, platform) != ("installs", "ios"):
                write(tmp_path / "files" / "attribution" / report / f"{app}_1.csv",
                      f"{header}\n{platform},2026-06-01 10:00:00,organic\n")
    jobs = attribution_jobs(at, [("app.a", "android"), ("id1", "ios")])
    assert len(jobs) == 8
    with pytest.raises(RuntimeError, match=r"1 of 8 input\(s\): \['installs ios'\]"):
        land_many(jobs)
    rows = as_dicts(raw(at, "appsflyer_raw/raw_in_app_events"), "_platform")
    assert [(r["_platform"], r["_app_id"], r["_source"]) for r in rows] == [
        ("android", "app.a", "appsflyer"), ("ios", "id1", "appsflyer")
    ]
    assert raw(at, "appsflyer_raw/raw_installs").count() == 1


def test_campaign_windows_carry_their_own_dates(spark, tmp_path, at):
    root = tmp_path / "files" / "campaigns"
    write(root / "list" / "1.json", json.dumps([{"campaign_id": "c", "channel": "PUSH"}]))
    leaf = {"performance_stats": {"sent": 4, "click": 1}}
    answer = {"data": {"c": [{"platforms": {"IOS": {"locales": {"d": {"variations": {
        "all_variations": leaf}}}}}}]}}
    for first, last in stats_windows(at.date_from, at.date_to):
        write(root / "stats" / f"{first}_{last}" / "1.json", json.dumps(answer))
    assert land_many(campaign_jobs(at)) == {
        "campaigns": 1,
        "campaign stats 2026-06-01..2026-06-30": 1,
        "campaign stats 2026-07-01..2026-07-05": 1,
    }
    tables = {f"moengage_raw.{t}": raw(at, f"moengage_raw/{t}")
              for t in ("raw_campaigns", "raw_campaign_stats")}
    push = as_dicts(table("mart_moengage_push", tables, spark), "stats_date_from")
    assert [(r["stats_date_from"], r["stats_date_to"], r["click_rate"]) for r in push] == [
        (date(2026, 6, 1), date(2026, 6, 30), 0.25), (date(2026, 7, 1), date(2026, 7, 5), 0.25)
    ]


def test_android_files(spark, tmp_path, at):
    root = tmp_path / "files" / "android"
    for name in ("crashRateMetricSet", "anrRateMetricSet", "errorCountMetricSet",
                 "stuckBackgroundWakelockRateMetricSet", "excessiveWakeupRateMetricSet",
                 "slowStartRateMetricSet"):
        write(root / name / "1.json", json.dumps({"rows": [{"aggregationPeriod": "DAILY", "startTime": {"year": 2026, "month": 6, "day": 2}, "dimensions": [{"dimension": "versionCode", "stringValue": "12"}]}]}))
    write(root / "reviews" / "1.json", json.dumps({"reviews": [{"reviewId": "r"}]}))
    for kind in ("installs", "crashes"):
        write(root / "stats" / kind / f"{kind}_pkg_202606_overview.csv",
              "Date,Package Name,Daily Crashes\n2026-06-02,pkg,3\n", "utf-16")
    write(root / "stats" / "store_performance" / "store_performance_pkg_202606_country.csv",
          "Date,Package Name,Country / Region\n2026-06-02,pkg,ID\n", "utf-16")
    done = land_many(android_jobs(at, "pkg"))
    assert len(done) == 11
    assert done.pop("raw_gcs_store_performance_traffic") == 0
    assert set(done.values()) == {1}
    crashes = raw(at, "play_raw/raw_gcs_crashes").first()
    assert (crashes["daily_crashes"], crashes["_source"]) == ("3", "play_console_gcs")
    assert raw(at, "play_raw/raw_crash_rate").first()["versionCode"] == "12"


def test_ios_files(spark, tmp_path, at):
    root = tmp_path / "files" / "ios"
    review = {"id": "1", "attributes": {"createdDate": "2026-06-02T00:00:00Z", "rating": 5}}
    old = {"id": "0", "attributes": {"createdDate": "2026-05-02T00:00:00Z", "rating": 5}}
    write(root / "reviews" / "1.json", json.dumps({"data": [review, old]}))
    for name in IOS_REPORTS:
        (root / name).mkdir(parents=True)
        for n, header in enumerate(("Date\tCounts\tPre-Order", "Date\tPre-Order\tCounts")):
            cells = {"Date": "2026-06-01", "Counts": "7", "Pre-Order": "x"}
            line = "\t".join(cells[h] for h in header.split("\t"))
            (root / name / f"{n}.gz").write_bytes(gzip.compress(f"{header}\n{line}\n".encode()))
    done = land_many(ios_jobs(at))
    assert done == {"ios reviews": 1, **dict.fromkeys(IOS_REPORTS, 2)}
    rows = as_dicts(raw(at, "appstore_raw/raw_app_downloads"))
    assert {(r["counts"], r["pre_order"]) for r in rows} == {("7", "x")}
