"""The generated tables in the shape of the vendors' reports: text columns and load columns.

Every raw table is a projection of a whole generated table. Where a report covers one kind of
row (installs, errors), the kind is a value of the source table such as the event type.
Ratios are multiples of a power of two, so that sums and means do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from appkpi.operators.latest import LANDED_ROW


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A generated table, as its files give it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(**columns: str) -> list[str]:
    """Expressions as text columns."""
    return [f"CAST({e} AS STRING) AS `{name}`" for name, e in columns.items()]


def _load(
    ingested: str,
    run: str,
    first: str,
    last: str,
    platform: str = "''",
    source: str = "'generated'",
) -> list[str]:
    return [
        f"CAST({ingested} AS TIMESTAMP) AS _ingested_at",
        f"{source} AS _source",
        "'app' AS _app_id",
        f"{platform} AS _platform",
        f"{run} AS _run_id",
        f"CAST({first} AS DATE) AS _extract_from",
        f"CAST({last} AS DATE) AS _extract_to",
    ]


# ---- helper columns over events, lineitem and orders ----


def _hundredths(amount: str) -> str:
    """``round(amount * 100)`` as text. ``round`` goes by way of a decimal object for every row;
    ``rint`` does not and differs from it only halfway between two whole numbers."""
    x = f"{amount} * 100"
    whole = f"CASE WHEN abs({x} - rint({x})) = 0.5 THEN round({x}) ELSE rint({x}) END"
    return f"CAST(CAST({whole} AS BIGINT) AS STRING)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts",
        "CAST(ts AS DATE) AS day",
        "CAST(user_id AS STRING) AS uid",
        "event_type AS kind",
        "value AS val",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
        "lpad(CAST(event_id AS STRING), 15, '0') AS run",
    )
    return e.selectExpr(
        "*",
        "CASE WHEN k < 30 THEN 'Organic' WHEN k < 60 THEN 'Network A' ELSE 'Network B' END AS media",
        "CASE WHEN val < 20 THEN NULL WHEN val < 60 THEN '' WHEN val < 150 THEN 'spring' "
        "ELSE 'summer' END AS campaign",
        "CASE WHEN k < 50 THEN 'ID' ELSE 'SG' END AS country",
        "CASE WHEN hour(ts) < 12 THEN 'android' ELSE 'ios' END AS os",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS clock",
    )


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").selectExpr(
        "*",
        "CAST(l_shipdate AS DATE) AS day",
        "CAST(l_quantity AS BIGINT) AS qty",
        "CAST(l_linenumber AS BIGINT) AS line",
    )
    return li.selectExpr(
        "*",
        "floor(l_extendedprice * 4) / 4 AS cost",
        "CASE WHEN l_tax < 0.03 THEN NULL WHEN l_tax < 0.06 THEN 'dev-a' ELSE 'dev-b' END AS device",
        "CASE WHEN l_discount < 0.05 THEN 30 ELSE 33 END AS api",
        "CASE WHEN l_discount < 0.1 THEN 'ID' END AS country",
        "CASE WHEN l_discount < 0.05 THEN 'Product page' ELSE 'Store sheet' END AS page",
        "CASE WHEN line <= 3 THEN 'android' ELSE 'ios' END AS os",
        # whole hours later, without a zoned date-time per row
        "timestamp_micros(unix_micros(CAST(l_shipdate AS TIMESTAMP)) + qty * 3600000000) AS ingested",
        "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_partkey AS STRING), "
        "CAST(l_suppkey AS STRING), CAST(line AS STRING), CAST(qty AS STRING), "
        f"{_hundredths('l_extendedprice')}, {_hundredths('l_discount')}, {_hundredths('l_tax')}, "
        "l_returnflag, l_linestatus) AS run",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "*",
        "CAST(o_orderdate AS DATE) AS day",
        "CAST(floor(o_totalprice) AS BIGINT) AS price",
        "lpad(CAST(o_orderkey AS STRING), 15, '0') AS run",
    )


# ---- attribution ----


def _attribution_load(day: str = "day") -> list[str]:
    return _load("ts", "run", day, day, platform="os")


_EVENT_HEAD = {
    "Media Source": "media",
    "Campaign": "campaign",
    "Campaign ID": "concat('c', k)",
    "Country Code": "country",
    "Platform": "os",
}


def raw_installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("kind = 'signup'").selectExpr(
        *_text(**{"Appsflyer ID": "uid", "Install Time": "clock"}, **_EVENT_HEAD),
        *_text(Adset="concat('set-', k)", Ad="concat('ad-', k)"),
        *_attribution_load(),
    )


def raw_blocked_installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("kind = 'error'").selectExpr(
        *_text(**{"AppsFlyer ID": "uid", "Install Time": "clock"}, **_EVENT_HEAD),
        *_text(
            **{"Attributed Touch Type": "CASE WHEN k < 40 THEN 'click' ELSE 'impression' END"}
        ),
        *_attribution_load(),
    )


EVENT_NAMES = {
    "view": "SplashScreen_Loading",
    "click": "Login_PreLogin_Masuk",
    "purchase": "BeliTE_TransaksiSukses",
    "signup": "Onboarding_BuatPIN_Berhasil",
    "error": "Unmapped_Event",
}


def raw_in_app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in EVENT_NAMES.items())
    return events(spark, sf_dir).selectExpr(
        *_text(**{"Appsflyer ID": "uid", "Event Name": f"CASE kind {cases} END"}),
        *_text(**{"Event Time": "clock"}, **_EVENT_HEAD),
        *_attribution_load(),
    )


def raw_campaign_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost per campaign from the events, so that its days meet the installs' days."""
    return events(spark, sf_dir).selectExpr(
        *_text(**{"Install Time": "clock", "Media Source": "media"}),
        *_text(Campaign="campaign", GEO="country"),
        *_text(Impressions="k * 100", Clicks="k", Installs="CAST(floor(k / 10) AS BIGINT)"),
        *_text(Cost="coalesce(CAST(CASE WHEN k <> 7 THEN floor(val * 4) / 4 END AS STRING), 'n/a')"),
        *_attribution_load(),
    )


def raw_campaign_performance_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report over the largest table."""
    return lineitem(spark, sf_dir).selectExpr(
        *_text(**{"Install Time": "day", "Media Source": "l_returnflag"}),
        *_text(Campaign="CASE WHEN l_linestatus = 'O' THEN 'open' ELSE '' END", GEO="country"),
        *_text(Impressions="qty * 100", Clicks="qty", Installs="line - 1", Cost="cost"),
        *_load("ingested", "run", "day", "day", platform="os"),
    )


# ---- campaigns ----


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a version of its customer's campaign."""
    return orders(spark, sf_dir).selectExpr(
        *_text(
            campaign_id="o_custkey",
            channel="CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'PUSH' "
            "WHEN '2' THEN 'EMAIL' WHEN '3' THEN 'SMS' ELSE 'IN_APP' END",
            status="o_orderstatus",
            campaign_delivery_type="CASE WHEN price > 100000 THEN 'PERIODIC' ELSE 'ONE_TIME' END",
            created_at="o_orderdate",
            sent_time="''",
            basic_details="to_json(named_struct('name', concat('[', o_orderpriority, '] order ', "
            "o_orderkey), 'tags', array(o_orderstatus, o_orderpriority)))",
            segmentation_details="'{}'",
            conversion_goal_details="'{}'",
        ),
        *_load("o_orderdate", "run", "day", "day"),
    )


def raw_campaign_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).selectExpr(
        *_text(
            campaign_id="l_suppkey * 20",
            platform="CASE l_returnflag WHEN 'A' THEN 'ANDROID' WHEN 'R' THEN 'IOS' "
            "ELSE 'UNKNOWN' END",
            locale="concat('l', line)",
            variation="CASE WHEN l_linestatus = 'O' THEN 'all_variations' ELSE 'variation_1' END",
            sent="qty",
            impression="qty * line",
            click="line",
            ctr="qty / 64",
            attempted="qty - line",
            failed="''",
            device_start="'12.5'",
            delivery_rate="line / 8",
            sent_rate="''",
            failure_rate="'n/a'",
            delivery_funnel="to_json(named_struct('reachable_users_in_segment', qty + line))",
            conversion_goal_stats="CASE WHEN l_tax < 0.04 THEN '{}' "
            """ELSE concat('{"goal":', line, '}') END""",
        ),
        *_load("ingested", "run", "trunc(day, 'MM')", "last_day(day)"),
    )


# ---- Android store ----


def _rates(rate: str, bounds: bool) -> list[str]:
    own = {rate: "qty / 64", f"{rate}7dUserWeighted": "qty / 128"}
    own[f"{rate}28dUserWeighted"] = "qty / 256"
    if bounds:
        own[f"{rate}_ci_lower"] = "(qty - 1) / 64"
        own[f"{rate}_ci_upper"] = "CASE WHEN line < 7 THEN (qty + 1) / 64 END"
    return _text(**own)


def _health(rate: str, shift: int, bounds: bool = False) -> Callable[..., DataFrame]:
    """One rate per line; shifted versions, so that each report has keys the others lack."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lineitem(spark, sf_dir).selectExpr(
            *_text(date="day", aggregation_period="'DAILY'", metric_set=f"'{rate}MetricSet'"),
            *_text(versionCode=f"line + {shift}", deviceModel="device", apiLevel="api"),
            *_text(countryCode="country"),
            *_rates(rate, bounds),
            *_load("ingested", "run", "day", "day"),
        )

    return build


def raw_error_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("kind = 'error'").selectExpr(
        *_text(date="day", aggregation_period="'DAILY'", metric_set="'errorCountMetricSet'"),
        *_text(reportType="CASE WHEN k < 50 THEN 'CRASH' ELSE 'ANR' END", versionCode="uid"),
        *_text(deviceModel="campaign", apiLevel="CASE WHEN k < 30 THEN '30' ELSE '33x' END"),
        *_text(errorReportCount="k", distinctUsers="'1'"),
        *_load("ts", "run", "day", "day"),
    )


def raw_slow_start_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("kind = 'view'").selectExpr(
        *_text(date="day", aggregation_period="'DAILY'", metric_set="'slowStartRateMetricSet'"),
        *_text(versionCode="uid", deviceModel="campaign", apiLevel="'33'", countryCode="country"),
        *_text(startType="CASE WHEN k < 30 THEN 'COLD' WHEN k < 60 THEN 'WARM' ELSE 'HOT' END"),
        *_text(slowStartRate="k / 128", slowStartRate7dUserWeighted="k / 256"),
        *_text(slowStartRate28dUserWeighted="''"),
        *_load("ts", "run", "day", "day"),
    )


def raw_android_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews; the labelled ones carry a rating, the toxic ones a reply."""
    rated = read(spark, sf_dir, "documents").join(
        read(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return rated.selectExpr(
        *_text(
            review_id="concat('d', doc_id)",
            author_name="source",
            text="text",
            star_rating="coalesce(CAST(1 + 3 * quality + toxic AS STRING), '')",
            reviewer_language="lang",
            device="source",
            android_os_version="n_chars",
            app_version_code="''",
            app_version_name="'1.0'",
            device_product_name="source",
            device_manufacturer="lang",
            device_class="'PHONE'",
            device_ram_mb="n_chars",
            last_modified_seconds="1704067200 + n_chars * 60",
            developer_reply_text="CASE WHEN toxic = 1 THEN 'thanks' ELSE '' END",
            developer_reply_seconds="CASE WHEN toxic = 1 "
            "THEN CAST(1704067200 + doc_id AS STRING) ELSE '' END",
        ),
        *_load("'2024-03-01'", "lpad(CAST(doc_id AS STRING), 15, '0')", "'2024-03-01'", "'2024-03-01'"),
    )


def _order_load() -> list[str]:
    ingested = "timestamp_seconds(unix_seconds(CAST(o_orderdate AS TIMESTAMP)) + o_custkey)"
    return _load(ingested, "run", "day", "day")


def raw_gcs_installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).selectExpr(
        *_text(date="day", package_name="'app'", daily_device_installs="o_custkey"),
        *_text(daily_device_uninstalls="price", daily_device_upgrades="''"),
        *_text(total_user_installs="price", daily_user_installs="price"),
        *_text(daily_user_uninstalls="'1e3'", active_device_installs="price + 1"),
        *_text(install_events="o_custkey * 2", update_events="' 12 '", uninstall_events="'0x1F'"),
        *_order_load(),
    )


def raw_gcs_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty days later than the other files, so that each has days the others lack."""
    return lineitem(spark, sf_dir).selectExpr(
        *_text(date="date_add(day, 30)", package_name="'app'", daily_crashes="qty", daily_anrs="line"),
        *_load("ingested", "run", "day", "day"),
    )


def raw_gcs_store_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).selectExpr(
        *_text(date="day", package_name="'app'", country___region="l_returnflag"),
        *_text(store_listing_acquisitions="line", store_listing_visitors="(qty - 1) * 10"),
        *_text(store_listing_conversion_rate="line / 64"),
        *_load("ingested", "run", "day", "day"),
    )


# ---- iOS store ----


def _ios(**columns: str) -> list[str]:
    head = _text(date="day", app_name="'app'", app_apple_identifier="'1'", platform_version="'17'")
    return [*head, *_text(**columns), *_load("ingested", "run", "day", "day")]


DOWNLOAD_TYPE = (
    "CASE l_returnflag WHEN 'A' THEN 'First-time download' WHEN 'R' THEN 'Redownload' "
    "ELSE 'Auto-update' END"
)


def raw_app_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).selectExpr(
        *_ios(
            download_type=DOWNLOAD_TYPE,
            app_version="concat('v', line)",
            device="device",
            source_type="l_linestatus",
            page_type="page",
            pre_order="CAST(NULL AS STRING)",
            **{"pre-order": "CASE WHEN line = 1 THEN 'Yes' END"},
            territory="country",
            counts="qty",
        )
    )


def raw_app_installs_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).selectExpr(
        *_ios(
            event="CASE WHEN l_linestatus = 'O' THEN 'Install' ELSE 'Delete' END",
            download_type=DOWNLOAD_TYPE,
            app_version="concat('v', line)",
            device="device",
            source_type="l_linestatus",
            page_type="page",
            app_download_date="day",
            territory="country",
            counts="qty",
            unique_devices="line",
        )
    )


def raw_app_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).selectExpr(
        *_text(date="day", app_name="'app'", app_apple_identifier="'1'", platform_version="'17'"),
        *_text(
            app_version="concat('v', substr(o_orderpriority, 1, 1))",
            device="CASE o_orderstatus WHEN 'O' THEN 'iPhone' WHEN 'F' THEN 'iPad' END",
            source_type="o_orderpriority",
            page_type="'Product page'",
            app_download_date="''",
            territory="o_orderstatus",
            sessions="CAST(floor(price / 100000) AS BIGINT)",
            total_session_duration="price",
            unique_devices="o_custkey",
        ),
        *_order_load(),
    )


def raw_app_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).selectExpr(
        *_ios(
            event="CASE l_returnflag WHEN 'A' THEN 'Impression' WHEN 'R' THEN 'Page view' "
            "ELSE 'Tap' END",
            page_type="page",
            source_type="l_linestatus",
            engagement_type="concat('e', line)",
            device="device",
            territory="country",
            counts="qty",
            unique_counts="line",
        )
    )


def raw_app_install_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).selectExpr(
        *_ios(
            download_type="l_linestatus",
            download_info="''",
            install_status="CASE l_returnflag WHEN 'A' THEN 'Success' WHEN 'R' THEN 'Failure' "
            "ELSE 'Pending' END",
            install_package_type="concat('p', line)",
            device="device",
            territory="country",
            counts="qty - 1",
            avg_install_duration="CASE WHEN line = 1 THEN '12.5' ELSE CAST(qty AS STRING) END",
        )
    )


def raw_ios_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as reviews, written at Jakarta time: some fall on the day before."""
    return read(spark, sf_dir, "conversations").selectExpr(
        *_text(
            review_id="concat(conv_id, '-', turn)",
            rating="CASE WHEN turn < 5 THEN CAST(turn + 1 AS STRING) ELSE '' END",
            title="role",
            body="text",
            reviewer_nickname="concat('c', conv_id)",
            territory="'IDN'",
            created_date="concat(date_add(DATE '2024-01-01', CAST(length(text) AS INT)), 'T', "
            "lpad(CAST(least(turn, 23) AS STRING), 2, '0'), ':30:00+07:00')",
        ),
        *_load(
            "'2024-03-01'",
            "concat(lpad(CAST(conv_id AS STRING), 15, '0'), '-', lpad(CAST(turn AS STRING), 6, '0'))",
            "'2024-03-01'",
            "'2024-03-01'",
        ),
    )


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "appsflyer_raw.raw_installs": raw_installs,
    "appsflyer_raw.raw_in_app_events": raw_in_app_events,
    "appsflyer_raw.raw_blocked_installs": raw_blocked_installs,
    "appsflyer_raw.raw_campaign_performance": raw_campaign_performance,
    "moengage_raw.raw_campaigns": raw_campaigns,
    "moengage_raw.raw_campaign_stats": raw_campaign_stats,
    "play_raw.raw_crash_rate": _health("crashRate", 0, True),
    "play_raw.raw_anr_rate": _health("anrRate", 2, True),
    "play_raw.raw_stuck_bg_wakelock_rate": _health("stuckBgWakelockRate", 4),
    "play_raw.raw_excessive_wakeup_rate": _health("excessiveWakeupRate", 5),
    "play_raw.raw_error_count": raw_error_count,
    "play_raw.raw_slow_start_rate": raw_slow_start_rate,
    "play_raw.raw_reviews": raw_android_reviews,
    "play_raw.raw_gcs_installs": raw_gcs_installs,
    "play_raw.raw_gcs_crashes": raw_gcs_crashes,
    "play_raw.raw_gcs_store_performance_country": raw_gcs_store_performance,
    "appstore_raw.raw_reviews": raw_ios_reviews,
    "appstore_raw.raw_app_downloads": raw_app_downloads,
    "appstore_raw.raw_app_installs_deletions": raw_app_installs_deletions,
    "appstore_raw.raw_app_sessions": raw_app_sessions,
    "appstore_raw.raw_app_discovery_engagement": raw_app_discovery,
    "appstore_raw.raw_app_install_performance": raw_app_install_performance,
}


class RawTables(dict):
    """Raw tables made on first use, so that a query plans only the reports it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._make = lambda name: RAW[name](spark, sf_dir)

    def __contains__(self, name: object) -> bool:
        return name in RAW

    def __missing__(self, name: str) -> DataFrame:
        # As landing numbers the rows it writes; here the run tells them apart.
        self[name] = self._make(name).selectExpr("*", f"xxhash64(_run_id) AS {LANDED_ROW}")
        return self[name]
