"""Column functions. All of them are JVM expressions; there is no Python UDF in the library."""

from appkpi.functions.casts import (
    epoch_to_timestamp,
    int_sql,
    json_fragment,
    json_scalar,
    json_scalar_sql,
    parse_sql,
    safe_date,
    safe_float,
    safe_int,
    safe_timestamp,
    timestamp_day,
)
from appkpi.functions.measures import count_where, ratio, sum_where, zero_if_missing

__all__ = [
    "count_where",
    "epoch_to_timestamp",
    "int_sql",
    "json_fragment",
    "json_scalar",
    "json_scalar_sql",
    "parse_sql",
    "ratio",
    "safe_date",
    "safe_float",
    "safe_int",
    "safe_timestamp",
    "sum_where",
    "timestamp_day",
    "zero_if_missing",
]
