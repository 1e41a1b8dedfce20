"""Steps over whole tables stay small: no second shuffle before a copy, no large input parts."""

from __future__ import annotations

from appkpi.plans import build
from workloads.queries import _in_utc


def test_copies_for_tests_are_written_where_their_rows_are(spark, raw, folder, monkeypatch):
    def shuffled(*args):
        raise AssertionError("a copy is dealt out again before it is written")

    monkeypatch.setattr(build, "write_table", shuffled)
    name = "stg_moengage_campaigns"
    rows = [{"campaign_id": str(i % 30), "channel": "PUSH", "status": "x"} for i in range(60)]
    tables = build.build_all(
        spark, {"moengage_raw.raw_campaigns": raw(rows)}, folder, names=[name], day_folders=False
    )
    assert sorted(int(r.campaign_id) for r in tables[name].collect()) == list(range(30))


def test_queries_read_small_parts(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    _in_utc(lambda session, folder: session.range(1))(spark, "")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "8m"
