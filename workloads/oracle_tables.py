"""DuckDB SQL for every table, straight from the generated tables.

Written from the meaning of the tables and not from the library: values are typed where they
come from, and outer joins, filters and windows are spelled out.
"""

from __future__ import annotations

# ---- helper relations over events, lineitem, orders ----

EVENTS = """
SELECT *,
    CASE WHEN k < 30 THEN 'Organic' WHEN k < 60 THEN 'Network A' ELSE 'Network B' END AS media,
    CASE WHEN val < 20 THEN NULL WHEN val < 60 THEN '' WHEN val < 150 THEN 'spring'
        ELSE 'summer' END AS campaign,
    CASE WHEN k < 50 THEN 'ID' ELSE 'SG' END AS country,
    CASE WHEN hour(ts) < 12 THEN 'android' ELSE 'ios' END AS os
FROM (
    SELECT event_id, ts, CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS uid,
        event_type AS kind, value AS val,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        lpad(CAST(event_id AS VARCHAR), 15, '0') AS run,
        date_trunc('second', ts) AS clock
    FROM events)
"""

LINEITEM = """
SELECT *, l_shipdate + to_hours(qty) AS ingested,
    concat_ws('-', l_orderkey, l_partkey, l_suppkey, line, qty,
        CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_discount * 100) AS BIGINT),
        CAST(round(l_tax * 100) AS BIGINT), l_returnflag, l_linestatus) AS run
FROM (
    SELECT *, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS qty,
        CAST(l_linenumber AS BIGINT) AS line, floor(l_extendedprice * 4) / 4 AS cost,
        CASE WHEN l_tax < 0.03 THEN NULL WHEN l_tax < 0.06 THEN 'dev-a' ELSE 'dev-b' END AS device,
        CAST(CASE WHEN l_discount < 0.05 THEN 30 ELSE 33 END AS BIGINT) AS api,
        CASE WHEN l_discount < 0.1 THEN 'ID' END AS country,
        CASE WHEN l_discount < 0.05 THEN 'Product page' ELSE 'Store sheet' END AS page,
        CASE WHEN l_linenumber <= 3 THEN 'android' ELSE 'ios' END AS os
    FROM lineitem)
"""

ORDERS = """
SELECT *, CAST(o_orderdate AS DATE) AS day, CAST(floor(o_totalprice) AS BIGINT) AS price,
    lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS run
FROM orders
"""


def _load(ingested: str, run: str, first: str, last: str) -> str:
    return f"""
    CAST({ingested} AS TIMESTAMP) AS _ingested_at, 'generated' AS _source, {run} AS _run_id,
    CAST({first} AS DATE) AS _extract_from, CAST({last} AS DATE) AS _extract_to"""


def _attribution_load(ingested: str = "ts") -> str:
    return f"""
    os AS _platform, 'app' AS _app_id, CAST({ingested} AS TIMESTAMP) AS _ingested_at,
    run AS _run_id, day AS _extract_from, day AS _extract_to"""


def _latest(select: str, key: str) -> str:
    return f"""SELECT * FROM ({select}) QUALIFY row_number() OVER (
    PARTITION BY {key} ORDER BY _ingested_at DESC, _run_id DESC) = 1"""


# ---- staging ----

INSTALL_KEY = "appsflyer_id, install_date, _platform"
HEALTH_KEY = "date, version_code, device_model, api_level, country_code"
EVENT_HEAD = (
    "media AS media_source, campaign, concat('c', k) AS campaign_id, country AS country_code, "
    "os AS platform"
)


def _health(rate: str, shift: int, bounds: str = "") -> str:
    name = "".join("_" + c.lower() if c.isupper() else c for c in rate)
    select = f"""SELECT day AS date, 'DAILY' AS aggregation_period,
    '{rate}MetricSet' AS metric_set, line + {shift} AS version_code, device AS device_model,
    api AS api_level, country AS country_code, qty / 64 AS {name}, {bounds}
    qty / 128 AS {name}_7d, qty / 256 AS {name}_28d, {_load("ingested", "run", "day", "day")}
    FROM ({LINEITEM})"""
    return _latest(select, HEALTH_KEY)


def _bounds(name: str) -> str:
    return f"""(qty - 1) / 64 AS {name}_ci_lower,
    CASE WHEN line < 7 THEN (qty + 1) / 64 END AS {name}_ci_upper,"""


IOS_HEAD = "day AS date, 'app' AS app_name, '1' AS app_apple_identifier, '17' AS platform_version"
LINE_LOAD = _load("ingested", "run", "day", "day")
ORDER_LOAD = _load("o_orderdate + to_seconds(o_custkey)", "run", "day", "day")
DOWNLOAD_TYPE = """CASE l_returnflag WHEN 'A' THEN 'First-time download'
    WHEN 'R' THEN 'Redownload' ELSE 'Auto-update' END AS download_type"""


def campaign_performance_rows(source: str) -> str:
    if source == "lineitem":
        select = f"""SELECT day AS date, l_returnflag AS media_source,
        CASE WHEN l_linestatus = 'O' THEN 'open' ELSE '' END AS campaign,
        country AS country_code, qty * 100 AS impressions, qty AS clicks, line - 1 AS installs,
        cost, {_attribution_load("ingested")} FROM ({LINEITEM})"""
    else:
        select = f"""SELECT day AS date, media AS media_source, campaign,
        country AS country_code, k * 100 AS impressions, k AS clicks, k // 10 AS installs,
        CASE WHEN k <> 7 THEN floor(val * 4) / 4 END AS cost, {_attribution_load()}
        FROM ({EVENTS})"""
    return _latest(select, "date, media_source, campaign, country_code, _platform")


STAGING: dict[str, str] = {
    "stg_appsflyer_installs": _latest(
        f"""SELECT uid AS appsflyer_id, clock AS install_time, day AS install_date,
        {EVENT_HEAD}, concat('set-', k) AS adset, concat('ad-', k) AS ad,
        CASE WHEN k < 30 THEN 'organic' ELSE 'paid' END AS media_type, {_attribution_load()}
        FROM ({EVENTS}) WHERE kind = 'signup'""",
        INSTALL_KEY,
    ),
    "stg_appsflyer_in_app_events": f"""
        SELECT uid AS appsflyer_id,
        CASE kind WHEN 'view' THEN 'SplashScreen_Loading' WHEN 'click' THEN 'Login_PreLogin_Masuk'
            WHEN 'purchase' THEN 'BeliTE_TransaksiSukses'
            WHEN 'signup' THEN 'Onboarding_BuatPIN_Berhasil' ELSE 'Unmapped_Event'
        END AS event_name, clock AS event_time, day AS event_date, {EVENT_HEAD},
        CASE kind WHEN 'view' THEN 'open_app' WHEN 'click' THEN 'login'
            WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'registrations'
        END AS event_category, {_attribution_load()} FROM ({EVENTS})""",
    "stg_appsflyer_blocked_installs": _latest(
        f"""SELECT uid AS appsflyer_id, clock AS install_time, day AS install_date,
        {EVENT_HEAD}, CASE WHEN k < 40 THEN 'click' ELSE 'impression' END AS blocked_reason,
        {_attribution_load()} FROM ({EVENTS}) WHERE kind = 'error'""",
        INSTALL_KEY,
    ),
    "stg_appsflyer_campaign_performance": campaign_performance_rows("events"),
    "stg_moengage_campaigns": _latest(
        f"""SELECT CAST(o_custkey AS VARCHAR) AS campaign_id,
        CASE left(o_orderpriority, 1) WHEN '1' THEN 'PUSH' WHEN '2' THEN 'EMAIL'
            WHEN '3' THEN 'SMS' ELSE 'IN_APP' END AS channel,
        o_orderstatus AS status,
        CASE WHEN price > 100000 THEN 'PERIODIC' ELSE 'ONE_TIME' END AS campaign_delivery_type,
        o_orderdate AS created_at, CAST(NULL AS TIMESTAMP) AS sent_time,
        '[' || o_orderpriority || '] order ' || o_orderkey AS campaign_name,
        '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS segment_tags,
        '{{"name":"[' || o_orderpriority || '] order ' || o_orderkey || '","tags":["'
            || o_orderstatus || '","' || o_orderpriority || '"]}}' AS basic_details,
        '{{}}' AS segmentation_details, '{{}}' AS conversion_goal_details,
        {_load("o_orderdate", "run", "day", "day")} FROM ({ORDERS})""",
        "campaign_id",
    ),
    "stg_moengage_campaign_stats": _latest(
        f"""SELECT CAST(l_suppkey * 20 AS VARCHAR) AS campaign_id,
        CASE l_returnflag WHEN 'A' THEN 'ANDROID' WHEN 'R' THEN 'IOS' ELSE 'UNKNOWN' END
            AS platform,
        concat('l', line) AS locale,
        CASE WHEN l_linestatus = 'O' THEN 'all_variations' ELSE 'variation_1' END AS variation,
        qty AS sent, qty * line AS impression, line AS click, qty / 64 AS ctr,
        qty - line AS attempted, CAST(NULL AS BIGINT) AS failed,
        CAST(NULL AS BIGINT) AS device_start, line / 8 AS delivery_rate,
        CAST(NULL AS DOUBLE) AS sent_rate, CAST(NULL AS DOUBLE) AS failure_rate,
        qty + line AS reachable_users_in_segment,
        '{{"reachable_users_in_segment":' || (qty + line) || '}}' AS delivery_funnel,
        CASE WHEN l_tax < 0.04 THEN '{{}}' ELSE '{{"goal":' || line || '}}' END
            AS conversion_goal_stats,
        {_load("ingested", "run", "date_trunc('month', day)", "last_day(day)")}
        FROM ({LINEITEM})""",
        "campaign_id, platform, locale, variation, _extract_from",
    ),
    "stg_play_console_crash_rate": _health(
        "crashRate", 0, _bounds("crash_rate")
    ),
    "stg_play_console_anr_rate": _health("anrRate", 2, _bounds("anr_rate")),
    "stg_play_console_stuck_bg_wakelock_rate": _health(
        "stuckBgWakelockRate", 4
    ),
    "stg_play_console_excessive_wakeup_rate": _health(
        "excessiveWakeupRate", 5
    ),
    "stg_play_console_error_count": _latest(
        f"""SELECT day AS date, 'DAILY' AS aggregation_period,
        'errorCountMetricSet' AS metric_set,
        CASE WHEN k < 50 THEN 'CRASH' ELSE 'ANR' END AS report_type,
        CAST(uid AS BIGINT) AS version_code, campaign AS device_model,
        CAST(CASE WHEN k < 30 THEN 30 END AS BIGINT) AS api_level, k AS error_report_count,
        CAST(1 AS BIGINT) AS distinct_users, {_load("ts", "run", "day", "day")}
        FROM ({EVENTS}) WHERE kind = 'error'""",
        "date, report_type, version_code, device_model, api_level",
    ),
    "stg_play_console_slow_start_rate": _latest(
        f"""SELECT day AS date, 'DAILY' AS aggregation_period,
        'slowStartRateMetricSet' AS metric_set, CAST(uid AS BIGINT) AS version_code,
        CASE WHEN k < 30 THEN 'COLD' WHEN k < 60 THEN 'WARM' ELSE 'HOT' END AS start_type,
        campaign AS device_model, CAST(33 AS BIGINT) AS api_level, country AS country_code,
        k / 128 AS slow_start_rate, k / 256 AS slow_start_rate_7d,
        CAST(NULL AS DOUBLE) AS slow_start_rate_28d, {_load("ts", "run", "day", "day")}
        FROM ({EVENTS}) WHERE kind = 'view'""",
        "date, version_code, start_type, device_model, api_level, country_code",
    ),
    "stg_play_console_reviews": """
        SELECT concat('d', doc_id) AS review_id, source AS author_name, text AS review_text,
        CAST(1 + 3 * quality + toxic AS BIGINT) AS star_rating, lang AS reviewer_language,
        source AS device, n_chars AS android_os_version, CAST(NULL AS BIGINT) AS app_version_code,
        '1.0' AS app_version_name, source AS device_product_name, lang AS device_manufacturer,
        'PHONE' AS device_class, n_chars AS device_ram_mb,
        1704067200 + n_chars * 60 AS last_modified_at,
        TIMESTAMP '2024-01-01' + to_minutes(n_chars) AS last_modified_at_ts,
        CASE WHEN toxic = 1 THEN 'thanks' END AS developer_reply_text,
        CASE WHEN toxic = 1 THEN 1704067200 + doc_id END AS developer_reply_at,
        CASE WHEN toxic = 1 THEN TIMESTAMP '2024-01-01' + to_seconds(doc_id) END
            AS developer_reply_at_ts,
        TIMESTAMP '2024-03-01' AS _ingested_at, 'generated' AS _source,
        lpad(CAST(doc_id AS VARCHAR), 15, '0') AS _run_id
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "stg_play_console_gcs_installs": _latest(
        f"""SELECT day AS date, 'app' AS package_name, o_custkey AS daily_device_installs,
        price AS daily_device_uninstalls, CAST(NULL AS BIGINT) AS daily_device_upgrades,
        price AS total_user_installs, price AS daily_user_installs,
        CAST(NULL AS BIGINT) AS daily_user_uninstalls, price + 1 AS active_device_installs,
        o_custkey * 2 AS install_events, CAST(12 AS BIGINT) AS update_events,
        CAST(31 AS BIGINT) AS uninstall_events, {ORDER_LOAD} FROM ({ORDERS})""",
        "date",
    ),
    "stg_play_console_gcs_crashes": _latest(
        f"""SELECT day + 30 AS date, 'app' AS package_name, qty AS daily_crashes,
        line AS daily_anrs, {LINE_LOAD} FROM ({LINEITEM})""",
        "date",
    ),
    "stg_play_console_gcs_store_performance": _latest(
        f"""SELECT day AS date, 'app' AS package_name, l_returnflag AS country,
        line AS store_listing_acquisitions, (qty - 1) * 10 AS store_listing_visitors,
        line / 64 AS store_listing_conversion_rate, {LINE_LOAD} FROM ({LINEITEM})""",
        "date, country",
    ),
    "stg_appstore_reviews": """
        SELECT concat(conv_id, '-', turn) AS review_id,
        CAST(CASE WHEN turn < 5 THEN turn + 1 END AS BIGINT) AS rating, role AS title,
        text AS body, concat('c', conv_id) AS reviewer_nickname, 'IDN' AS territory,
        created AS created_at_ts, CAST(created AS DATE) AS review_date,
        TIMESTAMP '2024-03-01' AS _ingested_at, 'generated' AS _source,
        lpad(CAST(conv_id AS VARCHAR), 15, '0') || '-' || lpad(CAST(turn AS VARCHAR), 6, '0')
            AS _run_id,
        DATE '2024-03-01' AS _extract_from, DATE '2024-03-01' AS _extract_to
        FROM (SELECT *, TIMESTAMP '2024-01-01 00:30:00' + to_days(CAST(length(text) AS INT))
            + to_hours(least(turn, 23) - 7) AS created FROM conversations)""",
    "stg_appstore_app_downloads": _latest(
        f"""SELECT {IOS_HEAD}, {DOWNLOAD_TYPE}, concat('v', line) AS app_version, device,
        l_linestatus AS source_type, page AS page_type,
        CASE WHEN line = 1 THEN 'Yes' END AS pre_order, country AS territory, qty AS counts,
        {LINE_LOAD} FROM ({LINEITEM})""",
        "date, download_type, app_version, device, source_type, page_type, territory",
    ),
    "stg_appstore_app_installs_deletions": _latest(
        f"""SELECT {IOS_HEAD},
        CASE WHEN l_linestatus = 'O' THEN 'Install' ELSE 'Delete' END AS event,
        {DOWNLOAD_TYPE}, concat('v', line) AS app_version, device,
        l_linestatus AS source_type, page AS page_type,
        CAST(day AS VARCHAR) AS app_download_date, country AS territory, qty AS counts,
        line AS unique_devices, {LINE_LOAD} FROM ({LINEITEM})""",
        "date, event, download_type, app_version, device, source_type, territory",
    ),
    "stg_appstore_app_sessions": _latest(
        f"""SELECT {IOS_HEAD}, concat('v', left(o_orderpriority, 1)) AS app_version,
        CASE o_orderstatus WHEN 'O' THEN 'iPhone' WHEN 'F' THEN 'iPad' END AS device,
        o_orderpriority AS source_type, 'Product page' AS page_type, '' AS app_download_date,
        o_orderstatus AS territory, price // 100000 AS sessions,
        price AS total_session_duration, o_custkey AS unique_devices, {ORDER_LOAD}
        FROM ({ORDERS})""",
        "date, app_version, device, source_type, territory",
    ),
    "stg_appstore_app_discovery_engagement": _latest(
        f"""SELECT {IOS_HEAD}, CASE l_returnflag WHEN 'A' THEN 'Impression'
            WHEN 'R' THEN 'Page view' ELSE 'Tap' END AS event,
        page AS page_type, l_linestatus AS source_type, concat('e', line) AS engagement_type,
        device, country AS territory, qty AS counts, line AS unique_counts, {LINE_LOAD}
        FROM ({LINEITEM})""",
        "date, event, page_type, source_type, engagement_type, device, territory",
    ),
    "stg_appstore_app_install_performance": _latest(
        f"""SELECT {IOS_HEAD}, l_linestatus AS download_type, '' AS download_info,
        CASE l_returnflag WHEN 'A' THEN 'Success' WHEN 'R' THEN 'Failure' ELSE 'Pending' END
            AS install_status,
        concat('p', line) AS install_package_type, device, country AS territory,
        qty - 1 AS counts, CASE WHEN line > 1 THEN qty END AS avg_install_duration, {LINE_LOAD}
        FROM ({LINEITEM})""",
        "date, download_type, install_status, install_package_type, device, territory",
    ),
}


# ---- marts and dashboards: SQL over the tables named in braces ----

KEYS5 = ("date", "media_source", "campaign", "country_code", "platform")


def _int(*sums: str) -> str:
    """``name=expression`` sums as bigint."""
    parts = [s.split("=", 1) for s in sums]
    return ", ".join(f"CAST(sum({e}) AS BIGINT) AS {n}" for n, e in parts)


def _ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif({b}, 0)"


def _merged(keys: tuple[str, ...], left: str, right: str) -> str:
    return ", ".join(f"coalesce({left}.{k}, {right}.{k}) AS {k}" for k in keys)


def _equal(keys: tuple[str, ...], left: str, right: str) -> str:
    return " AND ".join(f"{left}.{k} = {right}.{k}" for k in keys)


def _per_campaign_day(table: str, day: str, measures: str) -> str:
    return f"""(SELECT {day} AS date, media_source, campaign, country_code,
        _platform AS platform, {measures} FROM {{{table}}} GROUP BY ALL)"""


CAMPAIGN_RATIOS = f"""*, {_ratio("clicks", "impressions")} AS ctr,
    {_ratio("cost", "clicks")} AS cpc, {_ratio("cost", "installs")} AS cpi,
    {_ratio("cost", "impressions")} * 1000 AS cpm"""
CAMPAIGN_SUMS = (
    _int("impressions=impressions", "clicks=clicks", "installs=installs") + ", sum(cost) AS cost"
)


def _retained(days: int) -> str:
    return f"CAST(count(DISTINCT CASE WHEN gap = {days} THEN who END) AS BIGINT)"


def _push(columns: str, sums: str, extra: str = "") -> str:
    return f"""SELECT s.campaign_id, {columns}, s.platform, s._extract_from AS stats_date_from,
    s._extract_to AS stats_date_to, {sums} {extra}
    FROM {{stg_moengage_campaign_stats}} s
    LEFT JOIN {{stg_moengage_campaigns}} c ON s.campaign_id = c.campaign_id
    WHERE s.variation = 'all_variations' GROUP BY ALL"""


DOWNLOAD_SUMS = _int(
    "first_time_downloads=CASE WHEN download_type = 'First-time download' THEN counts ELSE 0 END",
    "redownloads=CASE WHEN download_type = 'Redownload' THEN counts ELSE 0 END",
    "total_downloads=counts",
)
SESSION_SUMS = _int(
    "sessions=sessions",
    "total_session_duration=total_session_duration",
    "unique_devices=unique_devices",
)
RATINGS = """SELECT review_date AS date, count(*) AS total_reviews,
    avg(CAST({rating} AS DOUBLE)) AS avg_rating,
    count(*) FILTER (WHERE {rating} <= 2) AS negative_reviews
    FROM {{{table}}} GROUP BY review_date"""


def _zero(alias: str, *columns: str) -> str:
    return ", ".join(f"coalesce({alias}.{c}, 0) AS {c}" for c in columns)


def _full_join_on_date(*inputs: tuple[str, str]) -> str:
    """Full outer chain on the running coalesced date."""
    (first, sql), *rest = inputs
    text, seen = f"({sql}) {first}", [first]
    for alias, relation in rest:
        known = ", ".join(f"{a}.date" for a in seen)
        known = f"coalesce({known})" if len(seen) > 1 else known
        text += f" FULL OUTER JOIN ({relation}) {alias} ON {known} = {alias}.date"
        seen.append(alias)
    return text


MARTS: dict[str, str] = {
    "mart_appsflyer_install_attribution": """SELECT appsflyer_id, install_date, install_time,
        media_source, media_type, campaign, campaign_id, adset, ad, country_code, platform,
        _platform, _app_id, _ingested_at FROM {stg_appsflyer_installs}""",
    "mart_appsflyer_campaign_performance": f"""SELECT {CAMPAIGN_RATIOS} FROM
        {_per_campaign_day("stg_appsflyer_campaign_performance", "date", CAMPAIGN_SUMS)}""",
    "mart_appsflyer_fraud": f"""SELECT {_merged(KEYS5, "b", "i")},
        coalesce(b.n, 0) AS blocked_installs, coalesce(b.n, 0) AS fraud_installs,
        coalesce(i.n, 0) AS installs,
        coalesce(b.n, 0) / (coalesce(b.n, 0) + coalesce(i.n, 0)) AS fraud_rate
        FROM {_per_campaign_day("stg_appsflyer_blocked_installs", "install_date", "count(*) AS n")} b
        FULL OUTER JOIN
        {_per_campaign_day("stg_appsflyer_installs", "install_date", "count(*) AS n")} i
        ON {_equal(KEYS5, "b", "i")}""",
    "mart_appsflyer_retention": f"""
        SELECT *, retained_d1 / cohort_size AS d1_retention,
        retained_d7 / cohort_size AS d7_retention,
        retained_d30 / cohort_size AS d30_retention FROM (
            SELECT cohort_date, media_source, campaign, country_code, platform,
            count(DISTINCT who) AS cohort_size, {_retained(1)} AS retained_d1,
            {_retained(7)} AS retained_d7, {_retained(30)} AS retained_d30
            FROM (SELECT i.install_date AS cohort_date, i.media_source, i.campaign,
                i.country_code, i._platform AS platform, i.appsflyer_id AS who,
                e.event_date - i.install_date AS gap
                FROM {{stg_appsflyer_installs}} i
                LEFT JOIN (SELECT * FROM {{stg_appsflyer_in_app_events}}
                    WHERE event_name = 'SplashScreen_Loading') e
                ON i.appsflyer_id = e.appsflyer_id)
            GROUP BY ALL)""",
    "mart_appsflyer_user_quality": f"""
        SELECT m.*, coalesce(c.cost, 0) AS cost,
        {_ratio("m.registrations", "m.installs")} AS conversion_rate,
        {_ratio("coalesce(c.cost, 0)", "m.registrations")} AS cost_per_registration
        FROM (SELECT {_merged(KEYS5, "e", "i")},
            {_zero("e", "open_app", "login", "purchase", "registrations")},
            {_zero("i", "installs")}
            FROM {_per_campaign_day("stg_appsflyer_in_app_events", "event_date", ", ".join(
                f"count(*) FILTER (WHERE event_category = '{c}') AS {c}"
                for c in ("open_app", "login", "purchase", "registrations")))} e
            FULL OUTER JOIN
            {_per_campaign_day("stg_appsflyer_installs", "install_date", "count(*) AS installs")} i
            ON {_equal(KEYS5, "e", "i")}) m
        LEFT JOIN {{mart_appsflyer_campaign_performance}} c
        ON {_equal(KEYS5, "m", "c")}""",
    "mart_moengage_push": f"""
        SELECT *, {_ratio("click", "sent")} AS click_rate,
        {_ratio("open_proxy", "sent")} AS open_proxy_rate FROM ({_push(
            "c.channel, c.status AS campaign_status, c.campaign_delivery_type",
            _int("sent=s.sent", "open_proxy=s.impression", "click=s.click"))})""",
    "mart_moengage_campaign_analytics": f"""
        SELECT *, {_ratio("open_proxy", "sent")} AS open_proxy_rate,
        {_ratio("click", "sent")} AS click_rate, {_ratio("sent", "attempted")} AS delivery_rate
        FROM ({_push(
            "c.campaign_name, c.channel, c.status AS campaign_status, "
            "c.campaign_delivery_type, c.segment_tags",
            _int("target_users=s.reachable_users_in_segment", "sent=s.sent",
                "open_proxy=s.impression", "click=s.click", "attempted=s.attempted",
                "failed=s.failed"),
            ", nullif(s.conversion_goal_stats, '{{}}') AS conversion_goal_stats_raw")})""",
    "mart_play_console_app_health": "SELECT * FROM "
    + " FULL OUTER JOIN ".join(
        f"(SELECT {HEALTH_KEY}, COLUMNS('^{rate}') FROM {{{table}}})" + using
        for rate, table, using in (
            ("crash_rate", "stg_play_console_crash_rate", ""),
            ("anr_rate", "stg_play_console_anr_rate", f" USING ({HEALTH_KEY})"),
            (
                "stuck_bg_wakelock_rate",
                "stg_play_console_stuck_bg_wakelock_rate",
                f" USING ({HEALTH_KEY})",
            ),
            (
                "excessive_wakeup_rate",
                "stg_play_console_excessive_wakeup_rate",
                f" USING ({HEALTH_KEY})",
            ),
        )
    ),
    "mart_play_console_gcs_stats": f"""
        SELECT coalesce(i.date, t.date, c.date) AS date, 'android' AS platform,
        i.daily_device_installs, i.daily_device_uninstalls, i.daily_device_upgrades,
        i.active_device_installs, i.install_events, i.uninstall_events,
        t.store_listing_impressions, t.store_listing_acquisitions,
        {_ratio("t.store_listing_acquisitions", "t.store_listing_impressions")}
            AS store_listing_conversion_rate,
        c.daily_crashes, c.daily_anrs
        FROM {_full_join_on_date(
            ("i", "SELECT * FROM {stg_play_console_gcs_installs}"),
            ("t", "SELECT date, " + _int("store_listing_impressions=store_listing_visitors",
                "store_listing_acquisitions=store_listing_acquisitions")
                + " FROM {stg_play_console_gcs_store_performance} GROUP BY date"),
            ("c", "SELECT * FROM {stg_play_console_gcs_crashes}"))}""",
    "mart_play_console_reviews": """
        SELECT *, CAST(last_modified_at_ts AS DATE) AS review_date,
        developer_reply_text IS NOT NULL AS has_developer_reply,
        star_rating <= 2 AS is_negative_review FROM {stg_play_console_reviews}""",
    "mart_appstore_acquisition": f"""
        SELECT *, first_time_downloads + redownloads AS app_units,
        {_ratio("first_time_downloads", "impressions")} AS conversion_rate
        FROM (SELECT coalesce(d.date, v.date) AS date,
            {_zero("d", "first_time_downloads", "redownloads", "total_downloads")},
            {_zero("v", "impressions", "product_page_views", "page_taps")}
            FROM {_full_join_on_date(
                ("d", f"SELECT date, {DOWNLOAD_SUMS} FROM {{stg_appstore_app_downloads}} "
                    "GROUP BY date"),
                ("v", "SELECT date, " + _int(
                    "impressions=CASE WHEN event = 'Impression' THEN counts ELSE 0 END",
                    "product_page_views=CASE WHEN event = 'Page view' "
                    "AND page_type = 'Product page' THEN counts ELSE 0 END",
                    "page_taps=CASE WHEN event = 'Tap' THEN counts ELSE 0 END")
                    + " FROM {stg_appstore_app_discovery_engagement} GROUP BY date"))})""",
    "mart_appstore_engagement": f"""
        SELECT *, {_ratio("total_session_duration", "sessions")} AS avg_session_duration,
        {_ratio("sessions", "unique_devices")} AS sessions_per_device
        FROM (SELECT coalesce(i.date, s.date) AS date,
            {_zero("i", "installs", "deletions", "active_devices")},
            {_zero("s", "sessions", "total_session_duration", "unique_devices")}
            FROM {_full_join_on_date(
                ("i", "SELECT date, " + _int(
                    "installs=CASE WHEN event = 'Install' THEN counts ELSE 0 END",
                    "deletions=CASE WHEN event = 'Delete' THEN counts ELSE 0 END",
                    "active_devices=CASE WHEN event = 'Install' THEN unique_devices ELSE 0 END")
                    + " FROM {stg_appstore_app_installs_deletions} GROUP BY date"),
                ("s", f"SELECT date, {SESSION_SUMS} FROM {{stg_appstore_app_sessions}} "
                    "GROUP BY date"))})""",
    "mart_appstore_reviews": """
        SELECT * EXCLUDE (_extract_from, _extract_to), rating <= 2 AS is_negative_review
        FROM {stg_appstore_reviews}""",
    "dash_acquisition_by_app_version": f"""
        SELECT 'ios' AS platform, date, app_version,
        {_zero("d", "first_time_downloads", "redownloads", "total_downloads")},
        {_zero("s", "sessions", "total_session_duration", "unique_devices")}
        FROM (SELECT date, app_version, {DOWNLOAD_SUMS} FROM {{stg_appstore_app_downloads}}
            GROUP BY ALL) d
        FULL OUTER JOIN (SELECT date, app_version, {SESSION_SUMS}
            FROM {{stg_appstore_app_sessions}} GROUP BY ALL) s USING (date, app_version)""",
    "dash_acquisition_by_device": f"""
        SELECT 'android' AS platform, date, device_model AS device,
        avg(crash_rate) AS avg_crash_rate, avg(anr_rate) AS avg_anr_rate,
        CAST(NULL AS BIGINT) AS sessions, CAST(NULL AS BIGINT) AS unique_devices,
        count(*) AS data_points
        FROM {{mart_play_console_app_health}} WHERE device_model IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT 'ios', date, device, NULL, NULL, {_int("a=sessions", "b=unique_devices")},
        count(*) FROM {{stg_appstore_app_sessions}} WHERE device IS NOT NULL
        GROUP BY date, device""",
    "dash_acquisition_by_os_version": """
        SELECT 'android' AS platform, date, CAST(api_level AS VARCHAR) AS os_version,
        avg(crash_rate) AS avg_crash_rate, avg(anr_rate) AS avg_anr_rate,
        count(*) AS data_points
        FROM {mart_play_console_app_health} WHERE api_level IS NOT NULL
        GROUP BY date, api_level""",
    "dash_overview_android": f"""
        SELECT coalesce(h.date, r.date, g.date) AS date, 'android' AS platform,
        h.avg_crash_rate, h.avg_anr_rate, h.avg_excessive_wakeup_rate,
        h.avg_stuck_bg_wakelock_rate, {_zero("r", "total_reviews", "negative_reviews")},
        r.avg_rating, g.daily_device_installs, g.daily_device_uninstalls,
        g.store_listing_impressions, g.store_listing_conversion_rate,
        g.daily_crashes AS daily_crash_count, g.daily_anrs AS daily_anr_count
        FROM {_full_join_on_date(
            ("h", "SELECT date, avg(crash_rate) AS avg_crash_rate, avg(anr_rate) AS avg_anr_rate, "
                "avg(excessive_wakeup_rate) AS avg_excessive_wakeup_rate, "
                "avg(stuck_bg_wakelock_rate) AS avg_stuck_bg_wakelock_rate "
                "FROM {mart_play_console_app_health} GROUP BY date"),
            ("r", RATINGS.format(rating="star_rating", table="mart_play_console_reviews")),
            ("g", "SELECT * FROM {mart_play_console_gcs_stats}"))}""",
    "dash_overview_ios": f"""
        SELECT coalesce(a.date, e.date, r.date, c.date) AS date, 'ios' AS platform,
        {_zero("a", "first_time_downloads", "redownloads", "app_units", "impressions",
            "product_page_views")}, a.conversion_rate,
        {_zero("e", "installs", "deletions", "sessions", "unique_devices")},
        e.installs - e.deletions AS net_installs, e.avg_session_duration,
        {_zero("r", "total_reviews", "negative_reviews")}, r.avg_rating,
        c.crash_rate, coalesce(c.total_install_attempts, 0) AS total_install_attempts
        FROM {_full_join_on_date(
            ("a", "SELECT * FROM {mart_appstore_acquisition}"),
            ("e", "SELECT * FROM {mart_appstore_engagement}"),
            ("r", RATINGS.format(rating="rating", table="mart_appstore_reviews")),
            ("c", "SELECT date, failures / nullif(total_install_attempts, 0) AS crash_rate, "
                "total_install_attempts FROM (SELECT date, " + _int(
                    "failures=CASE WHEN install_status = 'Failure' THEN counts ELSE 0 END",
                    "total_install_attempts=counts")
                + " FROM {stg_appstore_app_install_performance} "
                "WHERE install_status IN ('Success', 'Failure') GROUP BY date)"))}""",
    "dash_rating_distribution": """
        SELECT *, review_count / total_reviews AS pct FROM (
            SELECT *, CAST(sum(review_count) OVER (PARTITION BY platform) AS BIGINT)
                AS total_reviews
            FROM (SELECT 'android' AS platform, star_rating AS rating, count(*) AS review_count
                FROM {mart_play_console_reviews} GROUP BY ALL
                UNION ALL
                SELECT 'ios', rating, count(*) FROM {mart_appstore_reviews}
                WHERE rating IS NOT NULL GROUP BY rating))""",
    "dash_ratings_daily": " UNION ALL ".join(
        f"""SELECT review_date AS date, '{platform}' AS platform, count(*) AS review_count,
        avg(CAST({rating} AS DOUBLE)) AS avg_rating, """
        + ", ".join(f"count(*) FILTER (WHERE {rating} = {s}) AS rating_{s}" for s in range(1, 6))
        + f" FROM {{{table}}} GROUP BY review_date"
        for platform, rating, table in (
            ("android", "star_rating", "mart_play_console_reviews"),
            ("ios", "rating", "mart_appstore_reviews"),
        )
    ),
}


def table_sql(name: str) -> str:
    """One table as a single query; the tables it reads become subqueries."""
    if name in STAGING:
        return STAGING[name]
    text = MARTS[name]
    for other in (*STAGING, *MARTS):
        placeholder = "{" + other + "}"
        if placeholder in text:
            text = text.replace(placeholder, f"({table_sql(other)})")
    return text.replace("{{}}", "{}")
