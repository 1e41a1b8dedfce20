"""Load times of the generated reports are whole hours after the day, without a zoned date-time per row."""

from __future__ import annotations

from datetime import datetime

from conftest import plan_of

from workloads import raw_shapes


def test_load_times_are_hours_after_the_ship_date(spark, tmp_path):
    columns = (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    )
    shipped = [(datetime(1996, 2, 28), 50.0), (datetime(1969, 12, 31), 1.0), (None, 3.0), (datetime(1996, 2, 28), None)]
    rows = [(i, 1, 1, 1, qty, 10.0, 0.05, 0.02, "A", "F", at) for i, (at, qty) in enumerate(shipped)]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    loads = raw_shapes.lineitem(spark, str(tmp_path)).select("l_orderkey", "ingested")
    assert "interval" not in plan_of(loads).lower()
    found = dict(loads.selectExpr("l_orderkey", "date_format(ingested, 'yyyy-MM-dd HH')").collect())
    assert found == {0: "1996-03-01 02", 1: "1969-12-31 01", 2: None, 3: None}
