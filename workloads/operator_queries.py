"""Single operators on the generated tables, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
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
from appkpi.operators import (
    attach_lookup,
    bucket_by_window,
    cohort_retention,
    date_windows,
    full_outer_chain,
    half_open,
    in_date_range,
    keep_latest,
    lagged_window,
    months_between_dates,
    since,
    with_partition_total,
)
from appkpi.operators.latest import LANDED_ROW
from appkpi.plans import attribution, dashboards
from appkpi.plans.build import build_all, run_data_tests, table
from appkpi.plans.catalog import raw_name
from appkpi.plans.contracts import CONTRACTS
from appkpi.plans.incremental import refresh_new_loads
from appkpi.plans.staging import media_type, stage
from appkpi.quality import (
    Check,
    accepted_range,
    accepted_values,
    freshness_report,
    is_true,
    not_null,
    quality_report,
    unique,
)
from appkpi.quality.expectations import EXPECTATIONS, FRESHNESS
from appkpi.sources import flatten, landing, monthly, payloads
from appkpi.sources.files import folder_names, path_exists
from appkpi.sources.seeds import literal_table
from appkpi.sources.tables import publish_view, read_raw, read_table, write_table
from appkpi.sources.versions import read_version
from appkpi.streaming import stream_csv_to_raw, stream_latest
from workloads.oracle_tables import (
    CAMPAIGN_RATIOS,
    CAMPAIGN_SUMS,
    EVENTS,
    LINEITEM,
    ORDERS,
    campaign_performance_rows,
    table_sql,
)
from workloads.raw_shapes import (
    RawTables,
    events,
    lineitem,
    orders,
    raw_campaign_performance_lineitem,
    read,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}



def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on storage that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    )
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---- flagship ----


@query(
    f"""SELECT {CAMPAIGN_RATIOS} FROM (SELECT date, media_source, campaign, country_code,
    _platform AS platform, {CAMPAIGN_SUMS} FROM ({campaign_performance_rows("lineitem")})
    GROUP BY ALL)"""
)
def campaign_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_campaign_performance_lineitem(spark, sf_dir)
    return attribution.campaign_performance(stage(raw, "stg_appsflyer_campaign_performance"))


@query(
    """SELECT day AS date, l_returnflag, l_linestatus, CAST(sum(qty) AS BIGINT) AS impressions,
    count(*) AS clicks, count(*) FILTER (WHERE l_discount >= 0.05) AS installs,
    sum(cost) AS cost, count(*) / nullif(sum(qty), 0) AS ctr, sum(cost) / count(*) AS cpc,
    sum(cost) / nullif(count(*) FILTER (WHERE l_discount >= 0.05), 0) AS cpi,
    sum(cost) / nullif(sum(qty), 0) * 1000 AS cpm
    FROM ("""
    + LINEITEM
    + ") GROUP BY ALL"
)
def cost_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums, conditional counts and zero-guarded ratios over every line item."""
    totals = (
        lineitem(spark, sf_dir)
        .groupBy(F.col("day").alias("date"), "l_returnflag", "l_linestatus")
        .agg(
            F.sum("qty").alias("impressions"),
            F.count(F.lit(1)).alias("clicks"),
            F.count_if(F.col("l_discount") >= 0.05).alias("installs"),
            F.sum("cost").alias("cost"),
        )
    )
    return totals.withColumns(
        {
            "ctr": ratio("clicks", "impressions"),
            "cpc": ratio("cost", "clicks"),
            "cpi": ratio("cost", "installs"),
            "cpm": ratio("cost", "impressions") * 1000,
        }
    )


# ---- latest version, casts, scalar functions ----

LATEST_EVENTS = """SELECT event_id, ts, user_id, event_type, value, props,
    CAST(ts AS DATE) AS day FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
        ORDER BY ts DESC, event_id DESC) = 1"""
EVENT_KEY = ["user_id", "event_type", "day"]


NEWEST_EVENT = ["ts DESC", "event_id DESC"]


@query(LATEST_EVENTS)
def keep_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return keep_latest(rows, EVENT_KEY, NEWEST_EVENT)


@query(
    """SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS BIGINT) AS priority,
    CAST(NULL AS BIGINT) AS priority_text, CAST(NULL AS BIGINT) AS half,
    CAST(floor(o_totalprice) AS BIGINT) AS padded, o_orderkey AS from_hex,
    CAST(floor(o_totalprice) AS BIGINT) + 0.5 AS price, CAST(NULL AS DOUBLE) AS java_double,
    CAST(o_orderdate AS DATE) AS day, CAST(NULL AS DATE) AS year_only,
    CAST(NULL AS DATE) AS day_with_time, o_orderdate - INTERVAL 7 HOUR AS moment,
    CAST(NULL AS TIMESTAMP) AS time_only, CAST(o_orderkey AS VARCHAR) AS as_text FROM orders"""
)
def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_orderpriority",
        "CAST(floor(o_totalprice) AS STRING) AS price",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS day",
    )
    return text.select(
        "o_orderkey",
        safe_int("substr(o_orderpriority, 1, 1)").alias("priority"),
        safe_int("o_orderpriority").alias("priority_text"),
        safe_int("concat(price, '.5')").alias("half"),
        safe_int("concat(' ', price, ' ')").alias("padded"),
        safe_int("concat('0x', hex(o_orderkey))").alias("from_hex"),
        safe_float("concat(price, '.5')").alias("price"),
        safe_float("concat(price, 'd')").alias("java_double"),
        safe_date("day").alias("day"),
        safe_date("substr(day, 1, 4)").alias("year_only"),
        safe_date("concat(day, ' 00:00:00')").alias("day_with_time"),
        safe_timestamp("concat(day, 'T00:00:00+07:00')").cast("timestamp_ntz").alias("moment"),
        safe_timestamp("'10:00:00'").cast("timestamp_ntz").alias("time_only"),
        F.col("o_orderkey").cast("string").alias("as_text"),
    )


@query(
    """SELECT c_custkey, CASE WHEN lower(c_mktsegment) = 'building' THEN 'organic'
    ELSE 'paid' END AS media_type FROM customer"""
)
def media_type_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = read(spark, sf_dir, "customer").withColumn(
        "media_source", F.expr("CASE WHEN c_mktsegment = 'BUILDING' THEN 'ORGANIC' ELSE c_name END")
    )
    return named.select("c_custkey", media_type("media_source").alias("media_type"))


@query(
    """SELECT event_id, event_type, CASE event_type WHEN 'view' THEN 'open_app'
    WHEN 'signup' THEN 'registrations' WHEN 'purchase' THEN 'purchase' END AS category
    FROM events"""
)
def event_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = literal_table(
        spark,
        [("view", "open_app"), ("signup", "registrations"), ("purchase", "purchase")],
        ("event_type", "category"),
    )
    rows = read(spark, sf_dir, "events").select("event_id", "event_type")
    return attach_lookup(rows, lookup, "event_type")


@query(
    """SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS nested,
    CAST(NULL AS VARCHAR) AS missing, '[' || event_type || '] x' AS bracketed FROM events"""
)
def json_scalar_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = read(spark, sf_dir, "events").select(
        "event_id",
        "props",
        F.to_json(
            F.struct(
                F.array("event_type").alias("list"),
                F.concat(F.lit("["), "event_type", F.lit("] x")).alias("name"),
            )
        ).alias("wrapped"),
    )
    return wrapped.select(
        "event_id",
        json_scalar("props", "$.k").alias("k"),
        json_scalar("wrapped", "$.list").alias("nested"),
        json_scalar("wrapped", "$.nothing").alias("missing"),
        json_scalar("wrapped", "$.name").alias("bracketed"),
    )


@query(
    """SELECT event_id, '["' || event_type || '","' || user_id || '"]' AS tags,
    '"' || event_type || '"' AS quoted FROM events"""
)
def json_array_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = read(spark, sf_dir, "events").select(
        "event_id",
        F.to_json(
            F.struct(
                F.array("event_type", F.col("user_id").cast("string")).alias("tags"),
                F.col("event_type").alias("name"),
            )
        ).alias("j"),
    )
    return wrapped.select(
        "event_id",
        json_fragment("j", "$.tags").alias("tags"),
        json_fragment("j", "$.name").alias("quoted"),
    )


@query(
    """SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds,
    date_trunc('second', ts) AS moment, CAST(ts AS DATE) AS day,
    CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events"""
)
def epoch_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = safe_int("CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS STRING)")
    blank_errors = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type"))
    timed = read(spark, sf_dir, "events").select(
        "event_id", seconds.alias("seconds"), F.nullif(blank_errors, F.lit("")).alias("kind")
    )
    return timed.withColumn("moment", epoch_to_timestamp("seconds")).select(
        "event_id",
        "seconds",
        F.col("moment").cast("timestamp_ntz").alias("moment"),
        timestamp_day("moment").alias("day"),
        "kind",
    )


# ---- joins and totals ----

DAILY = {
    "placed": ("orders", "o_orderdate", "count(*)", "true"),
    "returned": ("lineitem", "l_shipdate", "count(*)", "l_returnflag = 'R'"),
    "urgent": ("orders", "o_orderdate", "count(*)", "o_orderpriority = '1-URGENT'"),
    "signups": ("events", "ts", "count(*)", "event_type = 'signup'"),
}


def _daily_sql(name: str) -> str:
    source, day, measure, rows = DAILY[name]
    return (
        f"(SELECT CAST({day} AS DATE) AS date, {measure} AS {name} FROM {source} "
        f"WHERE {rows} GROUP BY ALL)"
    )


@query("SELECT * FROM " + " FULL OUTER JOIN ".join(
    _daily_sql(n) + (" USING (date)" if i else "") for i, n in enumerate(DAILY)
))
def daily_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four daily counts side by side, by joins on the running coalesced day."""
    inputs = [
        read(spark, sf_dir, source)
        .filter(rows)
        .groupBy(F.to_date(day).alias("date"))
        .agg(F.count(F.lit(1)).alias(name))
        for name, (source, day, _, rows) in DAILY.items()
    ]
    return full_outer_chain(inputs, ["date"])


@query(
    """SELECT cohort_date, o_orderstatus, CAST(count(*) AS BIGINT) AS cohort_size, """
    + ", ".join(
        f"count(*) FILTER (WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.o_custkey "
        f"AND CAST(o.o_orderdate AS DATE) = cohort_date + {n})) AS retained_d{n}, "
        f"count(*) FILTER (WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.o_custkey "
        f"AND CAST(o.o_orderdate AS DATE) = cohort_date + {n})) / count(*) AS d{n}_retention"
        for n in (1, 7, 30)
    )
    + """ FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS cohort_date,
    o_orderstatus FROM orders) c GROUP BY ALL"""
)
def order_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who order again exactly 1, 7 and 30 days after an order."""
    placed = orders(spark, sf_dir)
    cohort = placed.select(
        "o_custkey", F.col("day").alias("cohort_date"), "o_orderstatus"
    ).distinct()
    return cohort_retention(
        cohort, placed, "o_custkey", "cohort_date", "day", ["o_orderstatus"]
    )


@query(
    """SELECT *, CAST(sum(n) OVER (PARTITION BY o_orderstatus) AS BIGINT) AS total,
    n / sum(n) OVER (PARTITION BY o_orderstatus) AS share
    FROM (SELECT o_orderstatus, CAST(left(o_orderpriority, 1) AS BIGINT) AS stars,
        count(*) AS n FROM orders GROUP BY ALL)"""
)
def partition_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = (
        read(spark, sf_dir, "orders")
        .withColumn("stars", safe_int("substr(o_orderpriority, 1, 1)"))
        .groupBy("o_orderstatus", "stars")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = with_partition_total(counted, "n", ["o_orderstatus"], "total")
    return totals.withColumn("share", ratio("n", "total"))


@query(
    "SELECT date, failures / nullif(total_install_attempts, 0) AS crash_rate, "
    "total_install_attempts FROM (SELECT date, CAST(sum(CASE WHEN install_status = 'Failure' "
    "THEN counts ELSE 0 END) AS BIGINT) AS failures, CAST(sum(counts) AS BIGINT) AS "
    f"total_install_attempts FROM ({table_sql('stg_appstore_app_install_performance')}) "
    "WHERE install_status IN ('Success', 'Failure') GROUP BY date)"
)
def install_failure_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = RawTables(spark, sf_dir)
    return dashboards.install_failures(table("stg_appstore_app_install_performance", raw, spark))


# ---- date ranges ----


def _windows_sql(days: int) -> str:
    return f"""SELECT CAST(s AS DATE) AS window_start,
    least(CAST(s AS DATE) + {days - 1}, hi) AS window_end, count(o_orderkey) AS orders
    FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
            INTERVAL {days} DAY)) AS s, hi
        FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
            FROM orders))
    LEFT JOIN orders ON o_orderdate >= s AND o_orderdate < s + INTERVAL {days} DAY
    GROUP BY ALL"""


def _windows(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """Orders per window, over the range that the orders span."""
    placed = orders(spark, sf_dir)
    first, last = placed.agg(F.min("day"), F.max("day")).first()
    counts = bucket_by_window(placed, "day", first, last, days).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("orders")
    )
    windows = date_windows(spark, first, last, days)
    return windows.join(counts, "window_start", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0))
    )


@query(_windows_sql(30))
def date_windows_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, 30)


@query(_windows_sql(1))
def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, 1)


@query(
    """SELECT strftime(s, '%Y%m') AS month, CAST(count(l_orderkey) AS BIGINT) AS rows,
    count(l_orderkey) = 0 AS missing
    FROM generate_series(TIMESTAMP '1994-11-01', TIMESTAMP '2002-03-01', INTERVAL 1 MONTH) w(s)
    LEFT JOIN lineitem ON strftime(l_shipdate, '%Y%m') = strftime(s, '%Y%m') GROUP BY ALL"""
)
def month_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months a range asks for, with the rows there are; a month without rows is reported."""
    months = months_between_dates(spark, date(1994, 11, 15), date(2002, 3, 2))
    there = (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.date_format("l_shipdate", "yyyyMM").alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    listed = months.join(there, "month", "left")
    return listed.select(
        "month", F.coalesce("rows", F.lit(0)).alias("rows"), F.col("rows").isNull().alias("missing")
    )


@query(
    """SELECT event_type, count(*) AS kept FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-20' GROUP BY ALL"""
)
def incremental_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = read(spark, sf_dir, "events").withColumn("created", F.col("ts").cast("string"))
    kept = text.filter(since("created", date(2024, 1, 20)))
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("kept"))


@query(
    """SELECT event_type, count(*) AS seen, count(*) AS seen_as_text FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-11' AND DATE '2024-01-12' GROUP BY ALL"""
)
def lagged_window_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days four and three days before a date, as a half-open range and as a text range."""
    first, last = lagged_window(date(2024, 1, 15))
    rows = read(spark, sf_dir, "events").select(
        "event_type",
        F.col("ts").cast("timestamp").alias("ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    in_text_range = in_date_range("day", first.isoformat(), last.isoformat())
    return (
        rows.filter(half_open("ts", first, last))
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("seen"),
            F.count_if(in_text_range).alias("seen_as_text"),
        )
    )


# ---- landing ----

LOADED_AT = datetime(2024, 3, 1, tzinfo=UTC)
LOAD = landing.Load(
    "generated", date(2024, 2, 1), date(2024, 2, 2), "app", "android", LOADED_AT, "run-1"
)
LOAD_SQL = """TIMESTAMP '2024-03-01' AS _ingested_at, 'generated' AS _source, 'app' AS _app_id,
    'android' AS _platform, 'run-1' AS _run_id, DATE '2024-02-01' AS _extract_from,
    DATE '2024-02-02' AS _extract_to"""


def _zone_free_load(df: DataFrame) -> DataFrame:
    return df.withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp_ntz"))


@query(
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, "
    "CAST(NULL AS VARCHAR) AS not_delivered FROM customer"
)
def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown columns dropped, missing ones NULL, names matched without regard to case."""
    text = read(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS C_CustKey", "c_mktsegment", "c_name AS unknown"
    )
    return landing.align_to_table(text, ["c_custkey", "c_mktsegment", "not_delivered"])


@query(
    "SELECT c_custkey AS customer_key, c_name AS customer___name, c_mktsegment AS pre_order "
    "FROM customer"
)
def header_snake(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS `Customer Key`", "c_name AS `Customer / Name `", "c_mktsegment AS `Pre-Order`"
    )
    return landing.snake_headers(named, slash=True)


@query(f"SELECT c_custkey, {LOAD_SQL} FROM customer")
def metadata_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zone_free_load(landing.stamp(read(spark, sf_dir, "customer").select("c_custkey"), LOAD))


def _landed(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch(spark, "raw")
    landing.land(df, path, LOAD)
    return _zone_free_load(read_raw(spark, path).drop(LANDED_ROW))


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS "Doc ID", text AS "Text", lang AS "Lang",
    {LOAD_SQL} FROM documents"""
)
def land_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents through quoted CSV: commas, quotes and newlines inside the cells."""
    folder = scratch(spark, "csv")
    read(spark, sf_dir, "documents").selectExpr(
        "doc_id AS `Doc ID`", "text AS `Text`", "lang AS `Lang`"
    ).write.csv(folder, header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False,
                ignoreTrailingWhiteSpace=False)
    return _landed(spark, landing.read_csv_report(spark, folder))


@query(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS order_status,
    CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS pre_order,
    {LOAD_SQL} FROM orders"""
)
def land_tsv_gz(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "tsv")
    read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS `Order Key`",
        "o_orderstatus AS `Order Status`",
        "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS `Pre-Order`",
    ).write.csv(folder, header=True, sep="\t", compression="gzip")
    return _landed(spark, landing.read_tsv_report(spark, folder))


@query(
    f"""SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS customer___name,
    {LOAD_SQL} FROM customer"""
)
def land_utf16(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "utf16")
    read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS `Customer Key`", "c_name AS `Customer / Name`"
    ).write.csv(folder, header=True, encoding="UTF-16")
    df = landing.read_csv_report(spark, folder, encoding="UTF-16")
    return _landed(spark, landing.snake_headers(df, slash=True))


@query(
    f"""SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
    '{{"user":' || user_id || ',"tags":["' || event_type || '"]}}' AS details,
    CASE WHEN event_type = 'view' THEN '' ELSE 'x' END AS sometimes, {LOAD_SQL} FROM events"""
)
def land_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects per line; nested values become JSON text, a missing key the empty text."""
    folder = scratch(spark, "json")
    read(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.struct(F.col("user_id").alias("user"), F.array("event_type").alias("tags")).alias(
            "details"
        ),
        F.when(F.col("event_type") != "view", F.lit("x")).alias("sometimes"),
    ).write.json(folder)
    return _landed(spark, landing.read_json_rows(spark, folder, multi_line=False))


@query(
    f"""SELECT CAST(c_custkey AS VARCHAR) AS "Customer Key", c_mktsegment AS "Segment",
    {LOAD_SQL.split(",", 1)[1]} FROM customer"""
)
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landed by a stream in several batches, each once; the load time varies."""
    folder, path = scratch(spark, "incoming"), scratch(spark, "raw")
    read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS `Customer Key`", "c_mktsegment AS `Segment`"
    ).write.csv(folder, header=True)
    for _ in range(2):  # the second run finds nothing new
        stream_csv_to_raw(
            spark, folder, ["Customer Key", "Segment"], path, LOAD,
            checkpoint=f"{path}-checkpoint", files_per_batch=2,
        ).awaitTermination()
    return read_raw(spark, path).drop("_ingested_at", LANDED_ROW)


@query(
    """SELECT CAST(c_nationkey AS VARCHAR) AS nation, CAST(max(c_custkey) AS VARCHAR) AS customer
    FROM customer GROUP BY c_nationkey"""
)
def stream_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a streamed load that share a key: the one that stands last in its file stays."""
    folder, path = scratch(spark, "incoming"), scratch(spark, "raw")
    rows = read(spark, sf_dir, "customer").repartition("c_nationkey").sortWithinPartitions("c_custkey")
    rows.selectExpr("c_nationkey AS nation", "c_custkey AS customer").write.csv(folder, header=True)
    stream_csv_to_raw(
        spark, folder, ["nation", "customer"], path, LOAD, checkpoint=f"{path}-checkpoint"
    ).awaitTermination()
    return keep_latest(read_raw(spark, path), ["nation"]).select("nation", "customer")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_key,
    CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS segment,
    CASE WHEN c_custkey % 2 = 1 THEN c_name ELSE '' END AS full_name,
    CASE WHEN c_custkey % 2 = 1 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS nation FROM customer"""
)
def land_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of gzip files with two headers, columns in another order, and files without a line."""
    customers, folder = read(spark, sf_dir, "customer"), scratch(spark, "incoming")
    shapes = {
        "c_custkey % 2 = 0": ("c_custkey AS `Customer Key`", "c_mktsegment AS `Segment`"),
        "c_custkey % 2 = 1": ("c_name AS `Full Name`", "c_custkey AS `Customer-Key`", "c_nationkey AS `Nation`"),
    }
    for rows, shape in shapes.items():
        customers.where(rows).selectExpr(*shape).write.mode("append").csv(
            folder, sep="\t", header=True, compression="gzip"
        )
    customers.where("c_custkey IS NULL").select("c_name").repartition(2).write.mode("append").csv(
        folder, sep="\t", header=False, compression="gzip"
    )
    return landing.read_tsv_report(spark, folder, mixed_headers=True)


# ---- nested payloads ----


@query(
    f"""SELECT 'crashRateMetricSet' AS metric_set, strftime(day, '%Y-%m-%d') AS date,
    'DAILY' AS aggregation_period, CAST(line AS VARCHAR) AS versionCode,
    CAST(api AS VARCHAR) AS apiLevel, coalesce(device, '') AS deviceModel, '' AS countryCode,
    CAST(qty AS VARCHAR) AS crashRate,
    CASE WHEN line < 7 THEN CAST(qty - 1 AS VARCHAR) ELSE '' END AS crashRate_ci_lower,
    CASE WHEN line < 7 THEN CAST(qty + 1 AS VARCHAR) ELSE '' END AS crashRate_ci_upper
    FROM ({LINEITEM})"""
)
def flatten_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def dimension(name: str, text: str = "NULL", number: str = "NULL") -> str:
        return (
            f"named_struct('dimension', '{name}', 'stringValue', CAST({text} AS STRING), "
            f"'int64Value', CAST({number} AS STRING))"
        )

    def number(value: str) -> str:
        return f"named_struct('value', CAST({value} AS STRING))"

    answer = f"""to_json(named_struct(
        'aggregationPeriod', 'DAILY',
        'startTime', named_struct('year', year(day), 'month', month(day), 'day', day(day)),
        'dimensions', array({dimension("versionCode", "line")}, {dimension("apiLevel", "NULL", "api")},
            {dimension("deviceModel", "device")}),
        'metrics', array(named_struct('metric', 'crashRate', 'decimalValue', {number("qty")},
            'decimalValueConfidenceInterval', CASE WHEN line < 7 THEN named_struct(
                'lowerBound', {number("qty - 1")}, 'upperBound', {number("qty + 1")}) END)))) AS j"""
    rows = lineitem(spark, sf_dir).selectExpr(answer)
    parsed = rows.select(F.from_json("j", payloads.METRIC_ROW).alias("r")).select("r.*")
    return flatten.flatten_metric_rows(
        parsed,
        "crashRateMetricSet",
        ("versionCode", "apiLevel", "deviceModel", "countryCode"),
        ("crashRate",),
    )


@query(
    f"""SELECT CAST(uid AS VARCHAR) AS campaign_id, os AS platform, kind AS locale,
    'v' || strftime(day, '%d') AS variation, CAST(count(*) AS VARCHAR) AS sent,
    CAST(sum(k) AS VARCHAR) AS click, '' AS failed, '' AS impression, '' AS ctr, '' AS attempted,
    '' AS device_start, '' AS delivery_rate, '' AS sent_rate, '' AS failure_rate,
    CAST(min(k) AS VARCHAR) AS "Least Opens",
    '{{"reachable_users_in_segment":' || max(k) || '}}' AS delivery_funnel,
    '{{}}' AS conversion_goal_stats FROM ({EVENTS}) GROUP BY ALL"""
)
def flatten_campaign_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per user, platform, type and day, nested three maps deep and taken apart again.

    The maps are put together per (user, platform, type), whose size is the number of days,
    and given as one answer each.
    """
    leaf = (
        events(spark, sf_dir)
        .groupBy("uid", "os", "kind", F.date_format("day", "'v'dd").alias("variation"))
        .agg(
            F.count(F.lit(1)).alias("sent"),
            F.sum("k").alias("click"),
            # a statistic that no staging table reads is landed all the same
            F.min("k").alias("Least Opens"),
            F.max("k").alias("reachable_users_in_segment"),
        )
        .select(
            "uid",
            "os",
            "kind",
            F.struct(
                "variation",
                F.struct(
                    F.struct("sent", "click", "Least Opens").alias("performance_stats"),
                    F.struct("reachable_users_in_segment").alias("delivery_funnel"),
                ),
            ).alias("leaf"),
        )
    )
    nested = leaf.groupBy("uid", "os", "kind").agg(
        F.map_from_entries(F.collect_list("leaf")).alias("variations")
    )
    answers = nested.select(
        F.col("uid").alias("campaign_id"),
        F.to_json(
            F.struct(
                F.create_map(
                    "os",
                    F.struct(F.create_map("kind", F.struct("variations")).alias("locales")),
                ).alias("platforms")
            )
        ).alias("one"),
    )
    # a list and a single entry are both accepted
    entries = answers.select(
        "campaign_id",
        F.when(F.length("campaign_id") > 1, F.concat(F.lit("["), "one", F.lit("]")))
        .otherwise(F.col("one"))
        .alias("entry"),
    )
    return flatten.flatten_campaign_stats(payloads.parse_campaign_stats(entries))


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS campaign_id, c_mktsegment AS channel,
    CASE WHEN c_nationkey < 5 THEN '' ELSE 'SENT' END AS status, '' AS campaign_delivery_type,
    '' AS created_at, '' AS sent_time, '{"name":"' || c_name || '"}' AS basic_details,
    '' AS segmentation_details, '' AS conversion_goal_details,
    CASE WHEN c_nationkey < 5 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS priority_level
    FROM customer"""
)
def campaign_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as search answers; ``priority_level`` is a key no staging table knows."""
    campaign = """named_struct('campaign_id', CAST(c_custkey AS STRING), 'channel', c_mktsegment,
        'basic_details', named_struct('name', c_name),
        'status', CASE WHEN c_nationkey >= 5 THEN 'SENT' END,
        'priority_level', CASE WHEN c_nationkey >= 5 THEN c_nationkey END)"""
    answers = read(spark, sf_dir, "customer").selectExpr(f"to_json(array({campaign})) AS value")
    return payloads.parse_campaign_list(answers)


@query(
    f"""SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber, l_quantity, {LOAD_SQL}
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber DESC, l_quantity DESC) = 1"""
)
def keep_latest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that tie within one load: the row that was stored with the highest number counts."""
    rows = read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity",
        f"l_linenumber * 1000L + CAST(l_quantity AS BIGINT) AS {LANDED_ROW}",
    )
    latest = keep_latest(landing.stamp(rows, LOAD), ["l_orderkey"])
    return _zone_free_load(latest.drop(LANDED_ROW))


@query(
    """SELECT concat('d', doc_id) AS review_id, source AS author_name, text,
    CAST(doc_id AS VARCHAR) AS last_modified_seconds,
    coalesce(CAST(quality AS VARCHAR), '') AS star_rating, lang AS reviewer_language,
    'phone' AS device, '14' AS android_os_version, '' AS app_version_code,
    '' AS app_version_name, source AS device_product_name, '' AS device_manufacturer,
    '' AS device_class, CAST(n_chars AS VARCHAR) AS device_ram_mb,
    CASE WHEN toxic = 1 THEN 'sorry' ELSE '' END AS developer_reply_text,
    CASE WHEN toxic = 1 THEN CAST(n_chars AS VARCHAR) ELSE '' END AS developer_reply_seconds
    FROM documents LEFT JOIN labels USING (doc_id)"""
)
def flatten_android_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as review answers; an older user comment comes before the one that counts."""
    answer = """to_json(named_struct('reviewId', concat('d', doc_id), 'authorName', source,
        'comments', array(
            named_struct('userComment', named_struct('text', 'older', 'lastModified',
                named_struct('seconds', '0'), 'starRating', 9, 'reviewerLanguage', '', 'device', '',
                'androidOsVersion', 0, 'deviceMetadata', CAST(NULL AS
                    STRUCT<productName: STRING, ramMb: BIGINT>)), 'developerComment', NULL),
            named_struct('userComment', named_struct('text', text, 'lastModified',
                named_struct('seconds', CAST(doc_id AS STRING)), 'starRating', quality,
                'reviewerLanguage', lang, 'device', 'phone', 'androidOsVersion', 14,
                'deviceMetadata', named_struct('productName', source, 'ramMb', n_chars)),
                'developerComment', CASE WHEN toxic = 1 THEN named_struct('text', 'sorry',
                    'lastModified', named_struct('seconds', CAST(n_chars AS STRING))) END)))) AS j"""
    rated = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    parsed = rated.selectExpr(answer).select(
        F.from_json("j", payloads.ANDROID_REVIEW).alias("r")
    )
    return flatten.flatten_android_reviews(parsed.select("r.*"))


@query(
    """SELECT concat(conv_id, '-', turn) AS review_id, CAST(turn AS VARCHAR) AS rating,
    role AS title, text AS body, '' AS reviewer_nickname,
    '2024-01-01T10:00:00+07:00' AS created_date, 'IDN' AS territory FROM conversations"""
)
def flatten_ios_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = """to_json(named_struct('id', concat(conv_id, '-', turn), 'attributes', named_struct(
        'rating', turn, 'title', role, 'body', text, 'createdDate', '2024-01-01T10:00:00+07:00',
        'territory', 'IDN'))) AS j"""
    parsed = read(spark, sf_dir, "conversations").selectExpr(answer).select(
        F.from_json("j", payloads.IOS_REVIEW).alias("r")
    )
    return flatten.flatten_ios_reviews(parsed.select("r.*"))


# ---- sinks ----


@query(
    f"""SELECT os, count(*) AS events, CAST(sum(k) AS BIGINT) AS total
    FROM ({EVENTS}) WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
    AND kind = 'purchase' GROUP BY ALL"""
)
def mart_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day and type on disk, then a week of one type read back pruned."""
    path = scratch(spark, "table")
    seen = events(spark, sf_dir).select("day", "kind", "os", "k")
    write_table(seen, path, "day", ["kind"])
    week = read_table(spark, path, seen.schema, "day", date(2024, 1, 8), date(2024, 1, 14))
    return (
        week.filter(F.col("kind") == "purchase")
        .groupBy("os")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("k").alias("total"))
    )


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def view_of_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    publish_view(read(spark, sf_dir, "orders"), "orders_view")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM orders_view GROUP BY ALL")


# ---- data tests ----


def _report_sql(name: str, tests: list[tuple[str, str, str, str]], source: str) -> str:
    """(test, columns, severity, failing-count SQL) over one relation."""
    rows = [
        f"""SELECT '{name}' AS "table", '{test}' AS test, '{columns}' AS columns,
        '{severity}' AS severity, CAST(({count}) AS BIGINT) AS failures"""
        for test, columns, severity, count in tests
    ]
    return (
        f"WITH t AS ({source}) SELECT *, CASE WHEN failures = 0 THEN 'pass' "
        "WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ("
        + " UNION ALL ".join(rows)
        + ")"
    )


def _count(where: str) -> str:
    return f"SELECT count(*) FROM t WHERE {where}"


@query(
    _report_sql(
        "orders",
        [
            ("not_null", "o_orderkey", "error", _count("o_orderkey IS NULL")),
            ("accepted_values", "o_orderstatus", "warn", _count("o_orderstatus NOT IN ('O', 'F')")),
            ("accepted_range", "o_totalprice", "warn", _count("o_totalprice > 100000")),
            ("accepted_range", "o_custkey", "error", _count("o_custkey <= 0")),
            ("expression_is_true", "o_totalprice", "error", _count("o_totalprice < 0")),
        ],
        "SELECT * FROM orders",
    )
)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        not_null("o_orderkey"),
        accepted_values("o_orderstatus", ["O", "F"]).warn(),
        accepted_range("o_totalprice", low=0, high=100000).warn(),
        accepted_range("o_custkey", low=0, inclusive=False),
        is_true("o_totalprice", ">= 0"),
    ]
    return quality_report(read(spark, sf_dir, "orders"), "orders", checks)


@query(
    _report_sql(
        "orders",
        [
            ("unique", "o_orderkey", "error", "SELECT 0"),
            (
                "unique",
                "o_custkey",
                "error",
                "SELECT count(*) FROM (SELECT o_custkey FROM t GROUP BY 1 HAVING count(*) > 1)",
            ),
        ],
        "SELECT * FROM orders",
    )
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [unique("o_orderkey"), unique("o_custkey")]
    return quality_report(read(spark, sf_dir, "orders"), "orders", checks)


@query(
    _report_sql(
        "lineitem",
        [
            (
                "unique_combination",
                "l_orderkey,l_linenumber",
                "error",
                "SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM t "
                "GROUP BY ALL HAVING count(*) > 1)",
            )
        ],
        "SELECT * FROM lineitem",
    )
)
def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(
        read(spark, sf_dir, "lineitem"), "lineitem", [unique("l_orderkey", "l_linenumber")]
    )


@query(
    _report_sql(
        "mart_play_console_reviews",
        [
            ("not_null", "review_id", "error", _count("review_id IS NULL")),
            ("not_null", "star_rating", "error", _count("star_rating IS NULL")),
            ("accepted_range", "star_rating", "warn", _count("star_rating NOT BETWEEN 1 AND 5")),
            ("not_null", "review_date", "error", _count("review_date IS NULL")),
            ("unique", "review_id", "error", "SELECT count(*) - count(DISTINCT review_id) FROM t"),
        ],
        table_sql("mart_play_console_reviews"),
    )
)
def dq_table_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered tests of one table; unrated reviews fail one of them."""
    name = "mart_play_console_reviews"
    return quality_report(
        table(name, RawTables(spark, sf_dir), spark), name, EXPECTATIONS[name]
    )


def _registered_sql(names: list[str]) -> str:
    """The registered tests of some tables, each counted by a statement of its own."""

    def failing(check: Check) -> str:
        if check.breaks is not None:
            return _count(check.sql)
        keys = ", ".join(check.columns)
        # One column: NULLs are no key. Several: NULL is a value like others.
        some = f"WHERE {keys} IS NOT NULL" if len(check.columns) == 1 else ""
        return f"SELECT count(*) FROM (SELECT 1 FROM t {some} GROUP BY {keys} HAVING count(*) > 1)"

    return " UNION ALL ".join(
        "SELECT * FROM ("
        + _report_sql(
            name, [(c.kind, ",".join(c.columns), c.severity, failing(c)) for c in EXPECTATIONS[name]], table_sql(name)
        )
        + ")"
        for name in names
    )


def _registered_tests(vendor: str) -> None:
    """Registers the tests of one vendor's tables, which are stored once and then tested."""
    names = [n for n in EXPECTATIONS if n.split("_", 1)[1].startswith(vendor)]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = build_all(spark, RawTables(spark, sf_dir), scratch(spark, "tables"), names=names, day_folders=False)
        return run_data_tests({n: tables[n] for n in names})

    run.__name__ = f"dq_{vendor}_tables"
    query(_registered_sql(names))(run)


for _vendor in ("appsflyer", "moengage", "play_console", "appstore"):
    _registered_tests(_vendor)


FRESH_AS_OF = datetime(2024, 2, 2, tzinfo=UTC)


def _all_ages_sql() -> str:
    now = "epoch_us(TIMESTAMP '2024-02-02')"
    newest = " UNION ALL ".join(
        f"SELECT '{raw_name(n)}' AS \"table\", max(_ingested_at) AS newest, "
        f"{FRESHNESS[raw_name(n)].warn_hours} AS warn_h, {FRESHNESS[raw_name(n)].error_hours} "
        f"AS error_h FROM ({table_sql(n)})"
        for n in CONTRACTS
    )
    return f"""SELECT "table", newest AS newest_load,
    ({now} - epoch_us(newest)) / 3600000000 AS age_hours,
    CASE WHEN {now} - epoch_us(newest) > error_h * 3600000000 THEN 'error'
    WHEN {now} - epoch_us(newest) > warn_h * 3600000000 THEN 'warn' ELSE 'pass' END AS status
    FROM ({newest})"""


@query(_all_ages_sql())
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw table that a table reads; the one landed for nobody has no generated rows."""
    raw = RawTables(spark, sf_dir)
    report = freshness_report({n: raw[n] for n in map(raw_name, CONTRACTS)}, FRESHNESS, FRESH_AS_OF)
    return report.withColumn("newest_load", F.col("newest_load").cast("timestamp_ntz"))


# ---- incremental ----


@query(LATEST_EVENTS)
def incremental_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest-version table built from a stream of event files, one file a batch."""
    incoming, path = scratch(spark, "incoming"), scratch(spark, "latest")
    rows = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    rows.write.parquet(incoming)
    stream = (
        spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(incoming)
    )
    stream_latest(
        stream, path, f"{path}-work", EVENT_KEY, NEWEST_EVENT, "day", f"{path}-checkpoint"
    ).awaitTermination()
    return read_table(spark, path, rows.schema)


@query(LATEST_EVENTS)
def versioned_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in two runs over half of the events each, for readers that run meanwhile."""
    incoming, path = scratch(spark, "incoming"), scratch(spark, "versions")
    rows = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for k in range(2):
        rows.where(half == k).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(rows.schema).parquet(incoming)
        stream_latest(
            stream, path, f"{path}-work", EVENT_KEY, NEWEST_EVENT, "day", f"{path}-checkpoint", versioned=True
        ).awaitTermination()
    return read_version(spark, path, rows.schema)


MONTH_RANGE = date(2026, 5, 3), date(2026, 7, 31)
OWN_PACKAGE = "com.example.app"
# Orders dealt over the days of May and June 2026; those of one status belong to another package.
MONTHLY_ROWS = """SELECT CAST(DATE '2026-05-01' + CAST(o_orderkey % 61 AS INT) AS DATE) AS day,
    CASE WHEN o_orderstatus = 'F' THEN 'com.example.other' ELSE 'com.example.app' END AS package,
    count(*) AS installs, sum(o_custkey) AS users FROM orders GROUP BY 1, 2"""


def _monthly_file(spark: SparkSession, rows: DataFrame, folder: str, month: str, encoding: str) -> None:
    """One report file of a month, as the store names it."""
    written = scratch(spark, "month")
    rows.coalesce(1).write.csv(written, header=True, encoding=encoding)
    path = spark._jvm.org.apache.hadoop.fs.Path
    storage = path(written).getFileSystem(spark._jsc.hadoopConfiguration())
    storage.mkdirs(path(folder))
    (part,) = [n for n in folder_names(spark, written) if n.startswith("part-")]
    storage.rename(path(f"{written}/{part}"), path(f"{folder}/installs_{OWN_PACKAGE}_{month}_overview.csv"))


@query(
    f"""SELECT CAST(day AS VARCHAR) AS date, package AS package_name, CAST(installs AS VARCHAR) AS daily_installs,
    CASE WHEN month(day) = 5 THEN CAST(users AS VARCHAR) ELSE '' END AS user___total,
    CASE WHEN month(day) = 5 THEN '202605' ELSE '202606' END AS month
    FROM ({MONTHLY_ROWS}) WHERE package = '{OWN_PACKAGE}' AND day >= DATE '2026-05-03'"""
)
def monthly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A UTF-16 month, a UTF-8 month with a column less and a month without a file; another package's rows go."""
    read(spark, sf_dir, "orders").createOrReplaceTempView("orders_by_month")
    days = spark.sql(MONTHLY_ROWS.replace("FROM orders", "FROM orders_by_month").replace(
        "DATE '2026-05-01' + CAST(o_orderkey % 61 AS INT)", "date_add(DATE '2026-05-01', CAST(o_orderkey % 61 AS INT))"
    ))
    folder = f"{scratch(spark, 'monthly')}/stats/installs"
    named = days.selectExpr(
        "day", "day AS `Date`", "package AS `Package Name`", "installs AS `Daily Installs`", "users AS `User / Total`"
    )
    _monthly_file(spark, named.where("month(day) = 5").drop("day"), folder, "202605", "UTF-16")
    _monthly_file(spark, named.where("month(day) = 6").drop("day", "User / Total"), folder, "202606", "UTF-8")
    rows = monthly.read_monthly_stats(spark, folder, "overview", OWN_PACKAGE, *MONTH_RANGE)
    return rows.withColumn("month", F.regexp_extract("_gcs_blob", r"_(\d{6})_overview", 1)).drop("_gcs_blob")


@query("SELECT 'land' AS step, count(*) AS landed, 1 AS tables FROM customer UNION ALL SELECT 'empty', 0, 0")
def empty_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are counted as they are written, and an input without rows, which leaves no table."""
    rows = read(spark, sf_dir, "customer").selectExpr("cast(c_custkey AS string) AS a")
    paths = {"land": scratch(spark, "raw"), "empty": scratch(spark, "raw")}
    counts = {"land": landing.land(rows, paths["land"], LOAD), "empty": landing.land(rows.where("a < '0'"), paths["empty"], LOAD)}
    return spark.createDataFrame(
        [(k, n, int(path_exists(spark, paths[k]))) for k, n in counts.items()], "step string, landed long, tables int"
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS campaign_id, o_orderstatus AS platform, 'l' AS locale, 'v' AS variation,
    CASE WHEN o_custkey % 3 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS sent,
    '' AS impression, '' AS click, '' AS ctr, '' AS attempted, '' AS failed, '' AS device_start, '' AS delivery_rate,
    '' AS sent_rate, '' AS failure_rate,
    CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority ELSE '' END AS stat_platform,
    CASE WHEN o_custkey % 2 = 1 THEN o_orderpriority ELSE '' END AS stat__source,
    '{}' AS delivery_funnel, '{}' AS conversion_goal_stats FROM orders"""
)
def campaign_stats_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics whose names differ in case, or are those of leaf and load columns."""
    entry = """concat('{"platforms":{"', o_orderstatus, '":{"locales":{"l":{"variations":{"v":{"performance_stats":{',
        CASE o_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN concat('"sent":', o_custkey, ',"Sent":0,')
            ELSE concat('"SENT":', o_custkey, ',') END,
        CASE o_custkey % 2 WHEN 0 THEN '"platform"' ELSE '"_source"' END, ':"', o_orderpriority, '"}}}}}}}}') AS entry"""
    entries = read(spark, sf_dir, "orders").selectExpr("cast(o_orderkey AS string) AS campaign_id", entry)
    return flatten.flatten_campaign_stats(payloads.parse_campaign_stats(entries))


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS campaign_id, '' AS channel, c_mktsegment AS status,
    '' AS campaign_delivery_type, '' AS created_at, '' AS sent_time, '' AS basic_details, '' AS segmentation_details,
    '' AS conversion_goal_details, c_name AS "campaign__run_id" FROM customer"""
)
def campaign_list_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns that spell a key in two ways, and have one called like a load column."""
    value = """concat('[{"campaign_id":', c_custkey, ',"', CASE WHEN c_custkey % 2 = 0 THEN 'Status' ELSE 'status' END,
        '":"', c_mktsegment, '","_run_id":"', c_name, '"}]') AS value"""
    return payloads.parse_campaign_list(read(spark, sf_dir, "customer").selectExpr(value))


@query(
    """SELECT month AS date, media_source, campaign, '' AS country_code, 'android' AS platform,
    impressions, impressions + 1 AS clicks, 1 AS installs, 2.0 AS cost FROM (
      SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS media_source,
        o_orderstatus AS campaign, o_orderkey AS impressions FROM orders
      QUALIFY row_number() OVER (PARTITION BY month, media_source, campaign
        ORDER BY CAST(o_custkey AS BIGINT) % 3 DESC, o_orderkey DESC) = 1)"""
)
def incremental_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed in three loads, each folded into the stored tables before the next one comes."""
    raw_root, tables = scratch(spark, "raw"), scratch(spark, "tables")
    rows = read(spark, sf_dir, "orders").selectExpr(
        "cast(date_trunc('month', o_orderdate) AS date) || ' 00:00:00' AS `Install Time`",
        "o_orderpriority AS `Media Source`", "o_orderstatus AS `Campaign`", "'' AS `GEO`",
        "cast(cast(o_orderkey AS bigint) AS string) AS `Impressions`",
        "cast(cast(o_orderkey AS bigint) + 1 AS string) AS `Clicks`", "'1' AS `Installs`", "'2' AS `Cost`",
        "cast(o_custkey AS bigint) % 3 AS part", f"cast(o_orderkey AS bigint) AS {LANDED_ROW}",
    )
    staging, mart = "stg_appsflyer_campaign_performance", "mart_appsflyer_campaign_performance"
    for number in range(3):
        load = landing.Load("generated", date(2026, 1, 1), date(2026, 1, 1), "app", "android",
                            datetime(2026, 1, 1 + number, tzinfo=UTC), f"run-{number}")
        stamped = landing.stamp(rows.where(F.col("part") == number).drop("part"), load)
        stamped.withColumn(landing.INGEST_DAY, F.to_date("_ingested_at")).write.mode("append").partitionBy(
            landing.INGEST_DAY
        ).parquet(f"{raw_root}/{raw_name(staging).replace('.', '/')}")
        found, _ = refresh_new_loads(spark, raw_root, tables, [mart])
    return found[mart].select(
        "date", "media_source", "campaign", "country_code", "platform", "impressions", "clicks", "installs", "cost"
    )
