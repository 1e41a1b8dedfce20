import gzip
import json
import logging
from datetime import UTC, date, datetime

import pytest
from conftest import as_dicts

from appkpi.sources import (
    METRIC_SETS,
    Load,
    align_to_table,
    expected_months,
    land,
    land_many,
    read_android_review_responses,
    read_campaign_list,
    read_campaign_stats_responses,
    read_csv_report,
    read_ios_review_responses,
    read_json_rows,
    read_metric_responses,
    read_monthly_stats,
    read_raw,
    read_tsv_report,
    snake_case,
    stamp,
)
from appkpi.sources.flatten import flatten_campaign_stats, merged_names
from appkpi.sources.files import READ_BYTES, first_line
from appkpi.sources.landing import METADATA, files_by_header
from appkpi.sources.payloads import parse_campaign_list, parse_campaign_stats

LOAD = Load("vendor", date(2026, 6, 1), date(2026, 6, 2), "app-1", "android")


def write(path, content, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content.encode(encoding))
    return str(path)


# ---- CSV ----


def test_csv_lands_as_text_with_load_columns(spark, tmp_path, folder):
    csv = write(
        tmp_path / "installs.csv",
        '﻿Install Time,Media Source,Campaign\n2024-02-29 23:59:59,search ads,\n'
        '2024-12-31 00:00:00,"a, ""b""\nc",x\n',
    )
    assert land(read_csv_report(spark, csv), folder, LOAD) == 2
    table = read_raw(spark, folder)
    assert table.columns == [
        "Install Time", "Media Source", "Campaign", *METADATA, "_landed_row"
    ]
    assert dict(table.dtypes) | METADATA == dict(table.dtypes)
    first, second = as_dicts(table, "Install Time")
    assert (first["Media Source"], first["Campaign"]) == ("search ads", "")
    assert second["Media Source"] == 'a, "b"\nc'
    assert (first["_source"], first["_app_id"], first["_platform"]) == (
        "vendor", "app-1", "android"
    )
    assert first["_extract_from"] == date(2026, 6, 1)
    assert first["_run_id"] == second["_run_id"] == LOAD.run_id


def test_header_only_writes_nothing(spark, tmp_path, folder):
    csv = write(tmp_path / "empty.csv", "Install Time,Media Source\n")
    assert land(read_csv_report(spark, csv), folder, LOAD) == 0
    assert not (tmp_path / folder).exists()


def test_second_load_drops_unknown_and_fills_missing(spark, tmp_path, folder, caplog):
    a = write(tmp_path / "a.csv", "Id,Name\n1,x\n")
    b = write(tmp_path / "b.csv", "ID,Extra\n2,y\n")
    land(read_csv_report(spark, a), folder, LOAD)
    with caplog.at_level(logging.WARNING):
        land(read_csv_report(spark, b), folder, LOAD)
    assert "Extra" in caplog.text
    rows = as_dicts(read_raw(spark, folder), "Id")
    assert [(r["Id"], r["Name"]) for r in rows] == [("1", "x"), ("2", None)]


def test_differing_headers_fail_or_are_read_apart(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "A,B\n1,2\n")
    write(tmp_path / "in" / "b.csv", "B,A,C\n3,4,5\n")
    source = str(tmp_path / "in")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_report(spark, source).collect()
    rows = as_dicts(read_csv_report(spark, source, mixed_headers=True), "A")
    assert rows == [{"A": "1", "B": "2", "C": ""}, {"A": "4", "B": "3", "C": "5"}]


# ---- TSV ----


def gz(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()))
    return str(path)


def test_gzip_tsv(spark, tmp_path, folder):
    tsv = gz(
        tmp_path / "downloads.tsv.gz",
        'Date\tDownload Type\tPre-Order\tCounts\n2024-02-28\tRestore\t\t0007\n'
        '2024-02-29\t"quoted\n2024-03-01\ta\tb\tc\textra\n',
    )
    assert land(read_tsv_report(spark, tsv), folder, LOAD) == 3
    rows = as_dicts(read_raw(spark, folder), "date")
    assert rows[0]["download_type"] == "Restore"
    assert (rows[0]["pre_order"], rows[0]["counts"]) == ("", "0007")
    assert (rows[1]["download_type"], rows[1]["pre_order"], rows[1]["counts"]) == ('"quoted', "", "")
    assert rows[2]["counts"] == "c"


def test_tsv_headers_that_drift(spark, tmp_path):
    gz(tmp_path / "in" / "a.gz", "Date\tPre-Order\n2026-06-01\tx\n")
    gz(tmp_path / "in" / "b.gz", "Date\tCounts\n2026-06-02\t5\n")
    rows = as_dicts(read_tsv_report(spark, str(tmp_path / "in"), mixed_headers=True), "date")
    assert [(r["date"], r["pre_order"], r["counts"]) for r in rows] == [
        ("2026-06-01", "x", ""), ("2026-06-02", "", "5")
    ]


def test_files_without_a_line_give_no_rows(spark, tmp_path, folder):
    gz(tmp_path / "in" / "a.gz", "")
    source = str(tmp_path / "in")
    assert land(read_tsv_report(spark, source, mixed_headers=True), folder, LOAD) == 0
    gz(tmp_path / "in" / "b.gz", "Date\tCounts\n2024-02-29\t5\n")
    assert land(read_tsv_report(spark, source, mixed_headers=True), folder, LOAD) == 1


def test_first_line(spark, tmp_path):
    wide = "\t".join(f"column {i}" for i in range(READ_BYTES // 5))
    for text, line in (
        (wide + "\n1\t2\n", wide), ("A,B", "A,B"), ("\n  \n \nA,B\r\n1,2\n", "A,B"), ("\tA\n", "\tA"),
        ("", ""), (" \n\n ", ""), ("\ufeffA\n", "A"),
    ):
        assert first_line(spark, write(tmp_path / "plain" / "a.csv", text)) == line
        assert first_line(spark, gz(tmp_path / "packed" / "a.gz", text)) == line


def test_every_file_lies_in_one_scan(spark, tmp_path):
    for name, header in (("a 1", "A,B"), ("b%20", "B,A"), ("c", "A,B"), ("d", "")):
        write(tmp_path / "in" / f"{name}.csv", f"{header}\n1,2\n" if header else "")
    source = str(tmp_path / "in")
    names = [[f.rsplit("/", 1)[1] for f in group] for group in files_by_header(spark, source)]
    assert names == [["a 1.csv", "c.csv"], ["b%20.csv"]]
    rows = read_csv_report(spark, source, mixed_headers=True)
    assert sorted((r["A"], r["B"]) for r in rows.collect()) == [("1", "2"), ("1", "2"), ("2", "1")]
    assert len(rows.inputFiles()) == 3


def test_headers_are_compared_in_the_file_s_encoding(spark, tmp_path):
    for name, text in (("a", "Date,Counts\n1,2\n"), ("b", "Counts,Date\n4,3\n")):
        (tmp_path / f"{name}.csv").write_bytes(text.encode("utf-16"))
    rows = read_csv_report(spark, str(tmp_path / "*.csv"), encoding="UTF-16", mixed_headers=True)
    assert [(r["Date"], r["Counts"]) for r in as_dicts(rows, "Date")] == [("1", "2"), ("3", "4")]


def test_snake_case():
    assert snake_case(" Download Type") == "download_type"
    assert snake_case("Pre-Order") == "pre_order"
    assert snake_case("Country / Region") == "country_/_region"
    assert snake_case("Country / Region", slash=True) == "country___region"


# ---- JSON ----


def test_json_rows_keep_nested_values_as_json(spark, tmp_path, folder):
    rows = [
        {"id": "1", "basic_details": {"name": "n", "tags": ["a", "b"]}, "n": 5},
        {"id": "2", "flag": True, "status": None},
    ]
    source = write(tmp_path / "campaigns.json", json.dumps(rows))
    land(read_json_rows(spark, source), folder, LOAD)
    one, two = as_dicts(read_raw(spark, folder), "id")
    assert json.loads(one["basic_details"]) == {"name": "n", "tags": ["a", "b"]}
    assert (one["n"], one["flag"]) == ("5", "")
    assert (two["basic_details"], two["flag"], two["status"]) == ("", "true", "")


def test_campaign_list_leaves_out_answers_that_are_no_list(spark, tmp_path):
    write(tmp_path / "in" / "1.json", json.dumps([{"campaign_id": "c1", "basic_details": {"a": 1}}]))
    write(tmp_path / "in" / "2.json", json.dumps({"error": "limit"}))
    write(tmp_path / "in" / "3.json", "[]")
    rows = as_dicts(
        read_campaign_list(spark, str(tmp_path / "in"), ["campaign_id", "basic_details", "status"])
    )
    assert rows == [{"campaign_id": "c1", "basic_details": '{"a":1}', "status": ""}]


# ---- stamp, align, failures ----


def test_run_id_and_load_time_are_per_load(spark):
    df = spark.range(100).repartition(5)
    rows = stamp(df, LOAD).select("_run_id", "_ingested_at").distinct().collect()
    assert len(rows) == 1
    assert Load("s", date(2026, 1, 1), date(2026, 1, 1)).run_id != LOAD.run_id


def test_align_types_missing_load_columns(spark):
    df = align_to_table(spark.createDataFrame([("x",)], "a string"), ["A", "_extract_from"])
    assert df.dtypes == [("A", "string"), ("_extract_from", "date")]


def test_one_bad_input_does_not_stop_the_others():
    ran = []

    def good(name):
        return lambda: ran.append(name) or 1

    def bad():
        raise ValueError("no file")

    with pytest.raises(RuntimeError, match=r"1 of 3 input\(s\): \['b'\]"):
        land_many([("a", good("a")), ("b", bad), ("c", good("c"))])
    assert ran == ["a", "c"]
    assert land_many([("a", good("a"))]) == {"a": 1}


# ---- monthly statistics ----


def monthly(tmp_path, month, rows, encoding, header="Date,Package Name,Daily Device Installs"):
    name = f"installs_pkg_{month}_overview.csv"
    return write(tmp_path / "stats" / "installs" / name, "\n".join([header, *rows]), encoding)


def test_monthly_files(spark, tmp_path, caplog):
    monthly(tmp_path, "202604", ["2026-04-30,pkg,1"], "utf-16")
    monthly(
        tmp_path, "202605", ["2026-05-30,pkg,2", "2026-05-31,other,3", "2026-05-31,pkg,4"], "utf-16"
    )
    monthly(
        tmp_path, "202607", ["2026-07-01,x,pkg,5", "2026-07-02,x,pkg,6"], "utf-8-sig",
        "Date,Country / Region,Package Name,Daily Device Installs",
    )
    source = str(tmp_path / "stats" / "installs")
    first, last = date(2026, 5, 31), date(2026, 7, 1)
    months = as_dicts(expected_months(spark, source, "overview", "pkg", first, last), "month")
    assert [(m["month"], m["path"] is None, m["utf16"]) for m in months] == [
        ("202605", False, True), ("202606", True, None), ("202607", False, False)
    ]
    with caplog.at_level(logging.WARNING):
        rows = as_dicts(read_monthly_stats(spark, source, "overview", "pkg", first, last), "date")
    assert "202606" in caplog.text
    assert [(r["date"], r["daily_device_installs"], r["country___region"]) for r in rows] == [
        ("2026-05-31", "4", ""), ("2026-07-01", "5", "x")
    ]
    assert rows[0]["_gcs_blob"].endswith("installs_pkg_202605_overview.csv")
    nothing = read_monthly_stats(
        spark, source, "overview", "pkg", date(2020, 1, 1), date(2020, 1, 2)
    )
    assert nothing is None


# ---- payloads ----


def test_metric_rows(spark, tmp_path):
    """The last entry of a name counts, text goes before number, what is missing is ''."""

    def size(n):
        return {"value": n}

    both = {"dimension": "countryCode", "stringValue": "ZZ", "int64Value": "9"}
    bounded = {"metric": "anrRate", "decimalValue": size("7"), "decimalValueConfidenceInterval": {"upperBound": size("8")}}
    rows = [
        {"startTime": {"year": 1999, "month": 2, "day": 3}, "dimensions": [both], "metrics": [bounded]},
        {"aggregationPeriod": "HOURLY", "dimensions": [{"dimension": "apiLevel", "int64Value": n} for n in ("20", "21")],
         "metrics": [bounded, {"metric": "anrRate", "decimalValue": size("1e-3")}, {"metric": "unheard", "decimalValue": size("4")}]},
        {},
    ]
    full = write(tmp_path / "full.json", json.dumps({"rows": rows}))
    write(tmp_path / "none.json", "{}")
    found = as_dicts(read_metric_responses(spark, [full, str(tmp_path / "none.json")], METRIC_SETS[1]), "countryCode", "apiLevel")
    names = ("date", "aggregation_period", "countryCode", "apiLevel", "versionCode", "anrRate", "anrRate_ci_lower", "anrRate_ci_upper")
    assert [tuple(r[n] for n in names) for r in found] == [
        ("-00-00", "", "", "", "", "", "", ""),
        ("-00-00", "HOURLY", "", "21", "", "1e-3", "", ""),
        ("1999-02-03", "", "ZZ", "", "", "7", "", "8"),
    ]
    assert {r["metric_set"] for r in found} == {"anrRateMetricSet"}


def test_metric_sets_name_the_tables_and_dimensions():
    by_name = {m.name: m for m in METRIC_SETS}
    assert len(by_name) == 6
    assert by_name["slowStartRateMetricSet"].dimensions == (
        "versionCode", "startType", "deviceModel", "apiLevel", "countryCode"
    )
    assert by_name["errorCountMetricSet"].metrics == ("errorReportCount", "distinctUsers")
    assert by_name["crashRateMetricSet"].metrics[2] == "crashRate28dUserWeighted"


def test_android_reviews(spark, tmp_path):
    """Of several comments of a kind the last counts, wherever the other kind stands."""

    def says(words, **more):
        return {"userComment": {"text": words, **more}}

    def answers(words, second):
        return {"developerComment": {"text": words, "lastModified": {"seconds": second}}}

    comments = {
        "r1": [answers("early", "5"), says("first", starRating=1), says("second", starRating=2, deviceMetadata={"ramMb": 64})],
        "r2": [says("only", lastModified={"seconds": "77"}), answers("one", "8"), answers("two", "9")],
        "r3": [],
    }
    listed = [{"reviewId": k, "comments": v} for k, v in comments.items()] + [{"reviewId": "r4", "authorName": "nobody"}]
    source = write(tmp_path / "answers.json", json.dumps({"reviews": listed}))
    found = as_dicts(read_android_review_responses(spark, source), "review_id")
    names = ("text", "star_rating", "last_modified_seconds", "device_ram_mb", "developer_reply_text", "developer_reply_seconds")
    assert [tuple(r[n] for n in names) for r in found] == [
        ("second", "2", "", "64", "early", "5"), ("only", "", "77", "", "two", "9"), ("",) * 6, ("",) * 6
    ]
    assert [r["author_name"] for r in found] == ["", "", "", "nobody"]


def test_names_merge_without_case_and_clashes_are_renamed():
    columns = merged_names(
        ["Sent", "sENT", "Opens", "opens", "platform", "Stat_Platform", "_SOURCE"], ("sent",), ("platform", "_source"), "stat_"
    )
    assert columns == {
        "sent": ["sent", "Sent", "sENT"], "Opens": ["Opens", "opens"], "stat__SOURCE": ["_SOURCE"],
        "Stat_Platform": ["Stat_Platform"], "stat_stat_platform": ["platform"],
    }


def test_campaign_keys_that_differ_in_case(spark, tmp_path):
    stats = [{"sent": 1, "Sent": 2, "Opens": 3}, {"SENT": 4, "opens": 5, "platform": "p", "_run_id": "mine"}, {"sent": None, "Sent": 6}]
    entries = [(f"c{k}", json.dumps({"platforms": {"IOS": {"locales": {"l": {"variations": {"v": {"performance_stats": s}}}}}}})) for k, s in enumerate(stats)]
    df = flatten_campaign_stats(parse_campaign_stats(spark.createDataFrame(entries, "campaign_id string, entry string")))
    path = str(tmp_path / "raw")
    assert land(df, path, LOAD) == 3
    rows = as_dicts(spark.read.parquet(path), "campaign_id")
    assert [(r["sent"], r["Opens"], r["stat_platform"], r["stat__run_id"], r["platform"], r["_run_id"]) for r in rows] == [
        ("1", "3", "", "", "IOS", LOAD.run_id), ("4", "5", "p", "mine", "IOS", LOAD.run_id), ("6", "", "", "", "IOS", LOAD.run_id)
    ]
    answers = [(json.dumps([{"campaign_id": "c", "Status": "a"}, {"status": "b", "STATUS": "z", "_Source": "s"}]),)]
    listed = parse_campaign_list(spark.createDataFrame(answers, "value string"))
    assert land(listed, str(tmp_path / "list"), LOAD) == 2
    assert [(r["status"], r["campaign__Source"]) for r in as_dicts(listed, "status")] == [("a", ""), ("b", "s")]


def test_a_load_reads_its_input_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    path = str(tmp_path / "raw")
    rows = spark.range(30).selectExpr("cast(id AS string) AS a").mapInArrow(count, "a string")
    assert land(rows, path, LOAD) == 30 and read.value == 30
    assert land(rows.where("a < 0"), str(tmp_path / "none"), LOAD) == 0 and not (tmp_path / "none").exists()
    before = sorted(p.name for p in (tmp_path / "raw").rglob("*.parquet"))
    assert land(rows.where("a < 0"), path, LOAD) == 0
    assert before == sorted(p.name for p in (tmp_path / "raw").rglob("*.parquet"))


def test_other_months_are_not_opened(spark, tmp_path):
    monthly(tmp_path, "202604", ["2026-04-30,pkg,1"], "utf-8")
    monthly(tmp_path, "202605", ["2026-05-30,pkg,2"], "utf-16")
    for month in ("202603", "202606"):
        # Would fail whoever reads it.
        (tmp_path / "stats" / "installs" / f"installs_pkg_{month}_overview.csv").mkdir()
    source = str(tmp_path / "stats" / "installs")
    df = read_monthly_stats(spark, source, "overview", "pkg", date(2026, 4, 1), date(2026, 5, 31))
    assert sorted(f.rsplit("/", 1)[1] for f in df.inputFiles()) == [f"installs_pkg_{m}_overview.csv" for m in ("202604", "202605")]
    assert df.count() == 2


def test_ios_reviews_since_a_day(spark, tmp_path):
    def review(name, created):
        return {"id": name, "attributes": {"rating": 5, "createdDate": created, "territory": "IDN"}}

    data = [review("new", "2026-06-02T01:00:00-07:00"), review("old", "2026-05-31T23:00:00-07:00")]
    source = write(tmp_path / "r.json", json.dumps({"data": data}))
    assert read_ios_review_responses(spark, source).count() == 2
    (row,) = as_dicts(read_ios_review_responses(spark, source, date(2026, 6, 1)))
    assert (row["review_id"], row["rating"], row["title"]) == ("new", "5", "")


def test_campaign_stats(spark, tmp_path):
    def entry(**platforms):
        return {"platforms": {
            p: {"locales": {"default": {"variations": {"all_variations": leaf}}}}
            for p, leaf in platforms.items()
        }}

    leaf = {"performance_stats": {"sent": 10, "ctr": 2.5, "new_field": 1},
            "delivery_funnel": {"reachable_users_in_segment": 7}, "conversion_goal_stats": {}}
    data = {
        "list": [entry(ANDROID=leaf, IOS={"performance_stats": {}})],
        "single": entry(ANDROID=leaf),
        "nothing": [{"platforms": {}}, {}],
    }
    source = write(tmp_path / "s.json", json.dumps({"data": data}))
    rows = as_dicts(read_campaign_stats_responses(spark, source), "campaign_id", "platform")
    assert [(r["campaign_id"], r["platform"], r["sent"]) for r in rows] == [
        ("list", "ANDROID", "10"), ("list", "IOS", ""), ("single", "ANDROID", "10")
    ]
    assert rows[0]["ctr"] == "2.5" and rows[0]["failed"] == ""
    # Statistics and campaign keys that no staging table reads are landed as well.
    assert [r["new_field"] for r in rows] == ["1", "", "1"]
    listed = write(tmp_path / "l.json", json.dumps([{"campaign_id": "c", "extra": {"a": 1}}]))
    (campaign,) = as_dicts(read_campaign_list(spark, listed))
    assert json.loads(campaign["extra"]) == {"a": 1} and campaign["channel"] == ""
    assert json.loads(rows[0]["delivery_funnel"]) == {"reachable_users_in_segment": 7}
    assert rows[1]["delivery_funnel"] == rows[0]["conversion_goal_stats"] == "{}"


def test_load_time_is_now():
    age = datetime.now(UTC) - Load("s", date(2026, 1, 1), date(2026, 1, 1)).ingested_at
    assert abs(age.total_seconds()) < 60
