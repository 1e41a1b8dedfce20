from datetime import date, datetime

import pytest
from conftest import as_dicts, at, day, plan_of
from pyspark.sql import functions as F

from appkpi.operators import (
    attach_lookup,
    bucket_by_window,
    cohort_retention,
    date_windows,
    full_outer_chain,
    half_open,
    keep_latest,
    lagged_window,
    merge_on_keys,
    months_between_dates,
    with_partition_total,
)
from appkpi.sources.seeds import EVENT_CATEGORIES, event_mapping, read_event_mapping

# ---- latest version ----


def test_latest_load_wins_and_null_keys_form_a_group(spark):
    rows = [("a", 1, at(1)), ("a", 2, at(2)), (None, 3, at(1)), (None, 4, at(3)), ("b", 5, at(1))]
    df = spark.createDataFrame(rows, "k string, v int, _ingested_at timestamp")
    assert {(r["k"], r["v"]) for r in keep_latest(df, ["k"]).collect()} == {
        ("a", 2), (None, 4), ("b", 5)
    }


def test_ties_of_one_load_do_not_depend_on_row_order(spark):
    rows = [("a", v, at(1), "r") for v in range(20)]
    schema = "k string, v int, _ingested_at timestamp, _run_id string"
    one = keep_latest(spark.createDataFrame(rows, schema), ["k"]).first()["v"]
    for n in (1, 3, 7):
        shuffled = spark.createDataFrame(rows[::-1], schema).repartition(n)
        assert keep_latest(shuffled, ["k"]).first()["v"] == one


def test_ties_of_one_load_go_by_the_stored_number(spark):
    rows = [("a", v, at(1), "r", 1000 - v) for v in range(20)]
    schema = "k string, v int, _ingested_at timestamp, _run_id string, _landed_row long"
    latest = keep_latest(spark.createDataFrame(rows, schema).repartition(3), ["k"])
    assert latest.first()["v"] == 0 and "xxhash64" not in plan_of(latest)


def test_an_input_that_repeats_a_key_is_refused(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([("x", 3)], "k string, b int")
    with pytest.raises(Exception, match="holds a key twice"):
        merge_on_keys({"a": a, "b": b}, ["k"]).collect()


def test_missing_load_time_loses(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, at(1))], "k string, v int, _ingested_at timestamp"
    )
    assert keep_latest(df, ["k"]).first()["v"] == 2


def test_latest_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id", "current_timestamp() AS _ingested_at")
    plan = plan_of(keep_latest(df, ["k"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


# ---- outer joins ----

LEFT = [("x", 1, 10), ("only-left", 1, 11), (None, 1, 12), ("", 1, 13)]
RIGHT = [("x", 1, 20), ("only-right", 1, 21), (None, 1, 22), ("", 1, 23)]
THIRD = [("x", 1, 30), ("only-right", 1, 31), ("only-third", 1, 32), (None, 1, 33)]


@pytest.fixture
def three(spark):
    return [
        spark.createDataFrame(rows, f"k string, n int, {name} int")
        for rows, name in ((LEFT, "a"), (RIGHT, "b"), (THIRD, "c"))
    ]


def test_null_keys_stay_apart_and_empty_ones_meet(three):
    rows = as_dicts(full_outer_chain(three[:2], ["k", "n"]))
    assert [(r["k"], r["a"], r["b"]) for r in rows] == [
        ("", 13, 23), ("only-left", 11, None), ("only-right", None, 21), ("x", 10, 20),
        (None, 12, None), (None, None, 22),
    ]


def test_merge_gives_the_rows_of_the_chain(three):
    chain = full_outer_chain(three, ["k", "n"])
    merged = merge_on_keys(dict(zip("abc", three, strict=True)), ["k", "n"])
    assert merged.columns == chain.columns
    assert as_dicts(merged) == as_dicts(chain)


def test_merge_with_required_inputs_is_a_left_join(three):
    a, b, c = three
    merged = merge_on_keys({"a": a, "b": b, "c": c}, ["k", "n"], required=("a", "b"))
    joined = full_outer_chain([a, b], ["k", "n"]).join(c, ["k", "n"], "left")
    assert as_dicts(merged) == as_dicts(joined)


def test_merge_refuses_ambiguous_columns(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="'v'"):
        merge_on_keys({"a": df, "b": df}, ["k"])


def test_merge_of_aggregates_shuffles_each_input_once(spark):
    def counted(n, name):
        return spark.range(1000).selectExpr(f"id % {n} AS k").groupBy("k").agg(
            F.count("*").alias(name)
        )

    inputs = {f"c{n}": counted(n, f"c{n}") for n in (3, 5, 7, 11)}
    assert plan_of(merge_on_keys(inputs, ["k"])).count("Exchange") == 4
    chain = plan_of(full_outer_chain(list(inputs.values()), ["k"]))
    assert chain.count("Exchange") > 4


# ---- lookup ----


def test_lookup_keeps_unmapped_rows_and_broadcasts_by_size(spark, tmp_path):
    path = tmp_path / "mapping.csv"
    path.write_text("event_name,category\nSplashScreen_Loading,open_app\n")
    facts = spark.createDataFrame([("SplashScreen_Loading",), ("other",)], "event_name string")
    joined = attach_lookup(facts, read_event_mapping(spark, str(path)), "event_name")
    assert {(r["event_name"], r["category"]) for r in joined.collect()} == {
        ("SplashScreen_Loading", "open_app"), ("other", None)
    }
    assert "BroadcastHashJoin" in plan_of(attach_lookup(facts, event_mapping(spark), "event_name"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(attach_lookup(facts, event_mapping(spark), "event_name"))
        assert "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_built_in_mapping(spark):
    assert {tuple(r) for r in event_mapping(spark).collect()} == set(EVENT_CATEGORIES)
    assert len(EVENT_CATEGORIES) == 7


# ---- retention ----


def test_retention_counts_exact_days_once(spark):
    cohort = spark.createDataFrame(
        [
            ("u1", day(1), "s"), ("u2", day(1), "s"), ("u3", day(1), "s"), ("u4", day(1), None),
            (None, day(1), "s"), ("u1", day(8), "s"),
        ],
        "u string, d date, source string",
    )
    activity = spark.createDataFrame(
        [
            ("u1", day(2)), ("u1", day(2)), ("u1", day(8)), ("u1", day(1, 7)), ("u2", day(3)),
            ("u3", day(8)), ("u4", day(2)), (None, day(2)), ("u9", day(2)), ("u3", None),
        ],
        "u string, day date",
    )
    rows = as_dicts(cohort_retention(cohort, activity, "u", "d", "day", ["source"]))
    found = {
        (r["d"], r["source"]): (
            r["cohort_size"], r["retained_d1"], r["retained_d7"], r["retained_d30"]
        )
        for r in rows
    }
    assert found == {
        (day(1), "s"): (4, 1, 2, 1),
        (day(1), None): (1, 1, 0, 0),
        (day(8), "s"): (1, 0, 0, 0),
    }
    assert next(r for r in rows if r["source"] is None)["d1_retention"] == 1.0


def test_retention_agrees_with_a_join_on_user_alone(spark):
    users = spark.range(400).selectExpr(
        "concat('u', id % 37) AS u", "date_add(DATE '2026-01-01', CAST(id * 7 % 41 AS INT)) AS d"
    )
    cohort, activity = users.distinct(), users.withColumnRenamed("d", "day")
    wide = (
        cohort.join(activity, "u", "left")
        .groupBy("u", "d")
        .agg(*[
            F.max((F.datediff("day", "d") == n).cast("int")).alias(f"r{n}") for n in (1, 7, 30)
        ])
        .groupBy("d")
        .agg(F.count("*").alias("size"), *[F.sum(f"r{n}").alias(f"r{n}") for n in (1, 7, 30)])
    )
    ours = cohort_retention(cohort, activity, "u", "d", "day", [])
    assert sorted(tuple(r) for r in wide.collect()) == sorted(
        tuple(r)[:5] for r in ours.collect()
    )


# ---- dates ----


@pytest.mark.parametrize(
    ("first", "last", "count"),
    [
        (day(1), day(20), 1), (day(1), day(30), 1), (day(1), day(1, 7), 2),
        (date(2026, 1, 1), date(2026, 3, 31), 3), (day(2), day(1), 0),
    ],
)
def test_windows_cover_the_range_without_gaps(spark, first, last, count):
    windows = [tuple(r) for r in date_windows(spark, first, last).orderBy("window_start").collect()]
    assert len(windows) == count
    if windows:
        assert windows[0][0] == first and windows[-1][1] == last
        assert all((e - s).days < 30 for s, e in windows)
        assert all((b[0] - a[1]).days == 1 for a, b in zip(windows, windows[1:], strict=False))


def test_rows_fall_into_the_windows(spark):
    days = spark.createDataFrame([(day(n),) for n in (1, 7, 8, 20, 30)], "d date")
    rows = bucket_by_window(days, "d", day(1), day(20), 7).collect()
    assert {(r["d"], r["window_start"], r["window_end"]) for r in rows} == {
        (day(1), day(1), day(7)), (day(7), day(1), day(7)), (day(8), day(8), day(14)),
        (day(20), day(15), day(20)),
    }


def test_months_lag_and_half_open_range(spark):
    months = months_between_dates(spark, date(2025, 12, 31), date(2026, 2, 1))
    assert [r[0] for r in months.orderBy("month").collect()] == ["202512", "202601", "202602"]
    assert months_between_dates(spark, day(1, 7), day(1)).count() == 0
    assert lagged_window(day(10)) == (day(6), day(7))
    moments = spark.createDataFrame(
        [(datetime(2026, 6, 7, 23, 59, 59),), (datetime(2026, 6, 8),)], "ts timestamp"
    )
    assert moments.filter(half_open("ts", day(7), day(7))).count() == 1


def test_partition_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4)], "p string, n bigint")
    totals = with_partition_total(df, "n", ["p"], "total")
    assert {tuple(r) for r in totals.collect()} == {("a", 1, 3), ("a", 2, 3), ("b", 4, 4)}
