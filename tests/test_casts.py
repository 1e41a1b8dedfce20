import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from appkpi.functions import (
    epoch_to_timestamp,
    json_fragment,
    json_scalar,
    ratio,
    safe_date,
    safe_float,
    safe_int,
    safe_timestamp,
    timestamp_day,
)


def evaluate(spark, text, column, kind="string"):
    return spark.createDataFrame([(text,)], f"t {kind}").select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("12", 12), (" 12 ", 12), ("-7", -7), ("+5", 5), ("0x1F", 31), ("0x" + "0" * 20 + "1f", 31), ("0x00", 0), ("-0x10", -16),
        ("", None), ("12.5", None), ("12.0", None), ("1e3", None), ("None", None), (None, None),
        ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), ("1 2", None),
    ],
)
def test_safe_int(spark, text, value):
    assert evaluate(spark, text, safe_int("t")) == value


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("12", 12.0), ("-0.5", -0.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0),
        ("1d", None), ("1f", None), ("0x1p3", None), ("", None), ("n/a", None), (None, None),
        ("inf", math.inf), ("-Infinity", -math.inf),
    ],
)
def test_safe_float(spark, text, value):
    assert evaluate(spark, text, safe_float("t")) == value


def test_safe_float_reads_nan(spark):
    assert math.isnan(evaluate(spark, "NaN", safe_float("t")))


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("2026-06-01", date(2026, 6, 1)), ("2026-6-1", date(2026, 6, 1)), ("2026", None),
        ("2026-06", None), ("2026-06-01 10:00:00", None), ("2026-02-30", None), ("-00-00", None),
        ("", None), (None, None),
    ],
)
def test_safe_date(spark, text, value):
    assert evaluate(spark, text, safe_date("t")) == value


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("2026-06-13 10:00:00", datetime(2026, 6, 13, 10)),
        ("2026-06-13T03:00:00+07:00", datetime(2026, 6, 12, 20)),
        ("2026-06-13", datetime(2026, 6, 13)),
        ("2026", None), ("10:00:00", None), ("", None), (None, None),
    ],
)
def test_safe_timestamp(spark, text, value):
    assert evaluate(spark, text, safe_timestamp("t").cast("timestamp_ntz")) == value


def test_day_is_cut_in_utc(spark):
    day = timestamp_day(safe_timestamp("t"))
    assert evaluate(spark, "2026-06-13T03:00:00+07:00", day) == date(2026, 6, 12)


def test_epoch(spark):
    moment = epoch_to_timestamp(safe_int("t")).cast("timestamp_ntz")
    assert evaluate(spark, "1781852861", moment) == datetime(2026, 6, 19, 7, 7, 41)
    assert evaluate(spark, "", moment) is None


@pytest.mark.parametrize(
    ("text", "scalar", "fragment"),
    [
        ('{"a": "x"}', "x", '"x"'),
        ('{"a": "[promo] x"}', "[promo] x", '"[promo] x"'),
        ('{"a": "[1, 2]"}', "[1, 2]", '"[1, 2]"'),
        ('{"a": 5}', "5", "5"),
        ('{"a": true}', "true", "true"),
        ('{"a": ["x", "y"]}', None, '["x","y"]'),
        ('{"a": {"b": 1}}', None, '{"b":1}'),
        ('{"a": null}', None, None),
        ("{}", None, None),
        ("{broken", None, None),
        (None, None, None),
    ],
)
def test_json_paths(spark, text, scalar, fragment):
    assert evaluate(spark, text, json_scalar("t", "$.a")) == scalar
    assert evaluate(spark, text, json_fragment("t", "$.a")) == fragment


@pytest.mark.parametrize(
    ("a", "b", "value"), [(1, 4, 0.25), (1, 0, None), (None, 2, None), (3, None, None), (6, 4, 1.5)]
)
def test_ratio(spark, a, b, value):
    df = spark.createDataFrame([(a, b)], "a bigint, b bigint")
    assert df.select(ratio("a", "b").alias("r")).first()["r"] == value
    assert df.select(ratio("a", F.col("b"))).schema.fields[0].dataType.simpleString() == "double"
