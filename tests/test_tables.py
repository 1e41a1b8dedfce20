"""The KPI tables on hand-made raw rows, with the expectations worked out by hand."""

import pytest
from conftest import as_dicts, at, day, plan_of

from appkpi.plans import android_store, attribution, campaigns, dashboards, ios_store
from appkpi.plans.build import table
from appkpi.plans.catalog import TABLES, raw_name
from appkpi.plans.contracts import CONTRACTS
from appkpi.plans.staging import stage, stage_in_app_events
from appkpi.sources.seeds import event_mapping


def install(user, moment="2026-06-01 10:00:00", **more):
    return {
        "Appsflyer ID": user, "Install Time": moment, "Media Source": "Net", "Campaign": "c",
        "Campaign ID": "1", "Adset": "s", "Ad": "a", "Country Code": "ID", "Platform": "android",
        **more,
    }


def event(user, name, moment="2026-06-01 10:00:00", **more):
    return {
        "Appsflyer ID": user, "Event Name": name, "Event Time": moment, "Media Source": "Net",
        "Campaign": "c", "Campaign ID": "1", "Country Code": "ID", "Platform": "android", **more,
    }


def cost(moment="2026-06-01", **more):
    return {
        "Install Time": moment, "Media Source": "Net", "Campaign": "c", "GEO": "ID",
        "Impressions": "1000", "Clicks": "10", "Installs": "4", "Cost": "2.5", **more,
    }


# ---- staging ----


def test_every_staging_table_is_planned_from_its_raw_columns(raw):
    for name, contract in CONTRACTS.items():
        columns = list(dict.fromkeys(f[2] if len(f) > 2 else f[0] for f in contract.fields))
        staged = stage(raw([], columns), name)
        assert set(contract.key) <= set(staged.columns)
        assert len(set(staged.columns)) == len(staged.columns)
    assert len(CONTRACTS) == 22 and len(TABLES) == 42


def test_installs_keep_the_latest_load_per_user_day_and_platform(raw):
    rows = raw([
        install("u1", **{"Media Source": "old", "_ingested_at": at(1)}),
        install("u1", **{"Media Source": "ORGANIC", "_ingested_at": at(2)}),
        install("u1", "2026-06-02 00:00:00"),
        install("u1", _platform="ios"),
        install("u2", "not a time", **{"Media Source": None}),
    ])
    staged = as_dicts(stage(rows, "stg_appsflyer_installs"), "appsflyer_id", "install_date")
    assert len(staged) == 4
    kept = [r for r in staged if r["install_date"] == day(1) and r["_platform"] == "android"]
    assert [(r["media_source"], r["media_type"]) for r in kept] == [("ORGANIC", "organic")]
    bad = staged[-1]
    assert (bad["install_time"], bad["install_date"], bad["media_type"]) == (None, None, "paid")


def test_two_rows_of_one_load_resolve_the_same_way(raw):
    rows = [install("u1", Ad=str(n)) for n in range(10)]
    kept = {
        stage(raw(order).repartition(n), "stg_appsflyer_installs").first()["ad"]
        for n, order in ((1, rows), (3, rows[::-1]))
    }
    assert len(kept) == 1


def test_blocked_installs_match_columns_without_regard_to_case(raw):
    rows = raw([{**install("u1"), "Attributed Touch Type": "click"}])
    staged = stage(rows, "stg_appsflyer_blocked_installs").first()
    assert (staged["appsflyer_id"], staged["blocked_reason"]) == ("u1", "click")


def test_events_keep_duplicates_and_unmapped_names(spark, raw):
    rows = raw([event("u", "Login_PreLogin_Masuk")] * 2 + [event("u", "Other")])
    staged = as_dicts(stage_in_app_events(rows, event_mapping(spark)), "event_name")
    assert [r["event_category"] for r in staged] == ["login", "login", None]


def test_downloads_use_either_spelling_of_the_renamed_column(raw):
    old = {"date": "2026-06-01", "download_type": "a", "pre-order": "x", "counts": "1"}
    new = {"date": "2026-06-01", "download_type": "b", "pre_order": "y", "counts": "z"}
    assert stage(raw([old]), "stg_appstore_app_downloads").first()["pre_order"] == "x"
    both = as_dicts(stage(raw([old, new]), "stg_appstore_app_downloads"), "download_type")
    assert [(r["pre_order"], r["counts"]) for r in both] == [("x", 1), ("y", None)]
    assert both[0]["territory"] is None


def test_campaign_json_columns(raw):
    rows = raw([
        {"campaign_id": "1", "created_at": "2026-06-01T10:00:00", "sent_time": "",
         "basic_details": '{"name": "[promo] x", "tags": ["a", "b"]}'},
        {"campaign_id": "2", "basic_details": '{"name": {"en": "x"}}'},
        {"campaign_id": "3", "basic_details": ""},
    ])
    staged = as_dicts(stage(rows, "stg_moengage_campaigns"), "campaign_id")
    assert [(r["campaign_name"], r["segment_tags"]) for r in staged] == [
        ("[promo] x", '["a","b"]'), (None, None), (None, None)
    ]
    assert staged[0]["sent_time"] is None and staged[0]["created_at"].hour == 10


def test_store_reviews_without_reply(raw):
    rows = raw([
        {"review_id": "1", "star_rating": "2", "last_modified_seconds": "1781852861",
         "developer_reply_text": "", "developer_reply_seconds": ""},
        {"review_id": "2", "star_rating": "", "last_modified_seconds": "x",
         "developer_reply_text": "hi", "developer_reply_seconds": "1781900000"},
    ])
    marts = android_store.reviews(stage(rows, "stg_play_console_reviews"))
    one, two = as_dicts(marts, "review_id")
    assert (one["has_developer_reply"], one["is_negative_review"]) == (False, True)
    assert one["review_date"] == day(19) and one["developer_reply_at_ts"] is None
    assert (two["has_developer_reply"], two["is_negative_review"]) == (True, None)
    assert two["review_date"] is None and two["developer_reply_at"] == 1781900000


# ---- attribution ----


def test_campaign_performance_ratios(raw):
    rows = raw([
        cost(), cost(GEO="SG", Impressions="0", Clicks="0", Installs="", Cost="n/a"),
        cost(Clicks="99", _ingested_at=at(1)),
    ])
    staged = stage(rows, "stg_appsflyer_campaign_performance")
    one, two = as_dicts(attribution.campaign_performance(staged), "country_code")
    assert (one["clicks"], one["ctr"], one["cpc"], one["cpi"], one["cpm"]) == (
        10, 0.01, 0.25, 0.625, 2.5
    )
    assert (two["installs"], two["ctr"], two["cpc"], two["cpi"], two["cpm"]) == (None,) * 5


def staged_installs(raw, *rows):
    return stage(raw(list(rows)), "stg_appsflyer_installs")


def test_fraud_rate_with_null_and_empty_campaigns(raw):
    blocked = stage(raw([
        {**install("b1"), "Attributed Touch Type": "click"},
        {**install("b2", Campaign=None), "Attributed Touch Type": "click"},
        {**install("b3", Campaign=""), "Attributed Touch Type": "click"},
        {**install("b4", Campaign="only-blocked"), "Attributed Touch Type": "click"},
    ]), "stg_appsflyer_blocked_installs")
    installs = staged_installs(
        raw, install("i1"), install("i2"), install("i3"), install("i4", Campaign=None),
        install("i5", Campaign=""), install("i6", Campaign="only-installs"),
    )
    rows = as_dicts(attribution.fraud(blocked, installs), "campaign", "installs")
    assert [
        (r["campaign"], r["blocked_installs"], r["fraud_installs"], r["installs"], r["fraud_rate"])
        for r in rows
    ] == [
        ("", 1, 1, 1, 0.5), ("c", 1, 1, 3, 0.25), ("only-blocked", 1, 1, 0, 1.0),
        ("only-installs", 0, 0, 1, 0.0), (None, 1, 1, 0, 1.0), (None, 0, 0, 1, 0.0),
    ]


def test_retention_ignores_duplicates_other_events_and_other_days(spark, raw):
    opened = "SplashScreen_Loading"
    events = [
        event("u1", opened, "2026-06-02 09:00:00"), event("u1", opened, "2026-06-02 10:00:00"),
        event("u2", opened, "2026-06-03 09:00:00"), event("u2", "Other", "2026-06-02 09:00:00"),
        event("u3", opened, "2026-06-08 00:00:00"), event("u3", opened, "2026-07-01 23:59:59"),
    ]
    installs = staged_installs(raw, *[install(u) for u in ("u1", "u2", "u3", "u4")])
    once = stage_in_app_events(raw(events), event_mapping(spark))
    twice = stage_in_app_events(raw(events * 2), event_mapping(spark))
    (row,) = as_dicts(attribution.retention(installs, once))
    assert (row["cohort_size"], row["retained_d1"], row["retained_d7"], row["retained_d30"]) == (
        4, 1, 1, 1
    )
    assert row["d1_retention"] == 0.25
    assert as_dicts(attribution.retention(installs, twice)) == [row]


def test_user_quality(spark, raw):
    events = stage_in_app_events(raw([
        event("u1", "SplashScreen_Loading"), event("u1", "Onboarding_BuatPIN_Berhasil"),
        event("u2", "Onboarding_BuatPIN_Berhasil"), event("u2", "BayarGadai_TransaksiSukses"),
        event("u3", "Login_BottomSheet_Masuk", Campaign="no-installs"), event("u4", "Other"),
    ]), event_mapping(spark))
    installs = staged_installs(raw, install("u1"), install("u5", Campaign="no-events"))
    performance = attribution.campaign_performance(stage(
        raw([cost(), cost(Campaign="no-events"), cost(Campaign="cost-only")]),
        "stg_appsflyer_campaign_performance",
    ))
    rows = as_dicts(attribution.user_quality(events, installs, performance), "campaign")
    assert [r["campaign"] for r in rows] == ["c", "no-events", "no-installs"]
    c, no_events, no_installs = rows
    assert (c["open_app"], c["login"], c["purchase"], c["registrations"]) == (1, 0, 1, 2)
    assert (c["conversion_rate"], c["cost"], c["cost_per_registration"]) == (2.0, 2.5, 1.25)
    assert (no_events["registrations"], no_events["conversion_rate"]) == (0, 0.0)
    assert (no_events["cost"], no_events["cost_per_registration"]) == (2.5, None)
    assert (no_installs["login"], no_installs["conversion_rate"], no_installs["cost"]) == (1, None, 0)


# ---- campaigns ----


def stats(campaign="1", **more):
    return {
        "campaign_id": campaign, "platform": "ANDROID", "locale": "default",
        "variation": "all_variations", "sent": "10", "impression": "20", "click": "5",
        "attempted": "8", "failed": "0", "delivery_funnel": '{"reachable_users_in_segment": 7}',
        "conversion_goal_stats": "{}", **more,
    }


@pytest.fixture
def push(raw):
    rows = [
        stats(), stats(locale="id", sent="30"), stats(variation="variation_1", sent="999"),
        stats("2", sent="0", attempted="0", conversion_goal_stats='{"goal":1}'), stats("9"),
    ]
    listed = raw([
        {"campaign_id": "1", "channel": "PUSH", "status": "SENT", "basic_details": '{"name":"n"}'},
        {"campaign_id": "2", "channel": "SMS", "status": "SENT", "basic_details": "{}"},
    ])
    return (
        stage(raw(rows), "stg_moengage_campaign_stats"), stage(listed, "stg_moengage_campaigns")
    )


def test_push_metrics(push):
    one, two, unknown = as_dicts(campaigns.push_metrics(*push), "campaign_id")
    assert (one["sent"], one["open_proxy"], one["click"]) == (40, 40, 10)
    assert (one["click_rate"], one["open_proxy_rate"], one["channel"]) == (0.25, 1.0, "PUSH")
    assert (two["click"], two["click_rate"]) == (5, None)
    assert (unknown["channel"], unknown["campaign_status"], unknown["sent"]) == (None, None, 10)


def test_campaign_analytics(push):
    one, two, _ = as_dicts(campaigns.campaign_analytics(*push), "campaign_id")
    assert (one["campaign_name"], one["target_users"], one["delivery_rate"]) == ("n", 14, 2.5)
    assert one["conversion_goal_stats_raw"] is None
    assert (two["delivery_rate"], two["conversion_goal_stats_raw"]) == (None, '{"goal":1}')


def test_statistics_are_grouped_before_the_join(push):
    plan = plan_of(campaigns.push_metrics(*push))
    join = plan.index("Join")
    assert "HashAggregate" not in plan[:join] and "HashAggregate" in plan[join:]


# ---- Android store ----


def health_rows(rate, *keys):
    return [
        {"date": "2026-06-01", "versionCode": v, "deviceModel": d, "apiLevel": a,
         "countryCode": c, rate: r}
        for v, d, a, c, r in keys
    ]


def test_app_health_merges_four_rates_and_keeps_null_keys_apart(raw):
    inputs = [
        stage(raw(health_rows("crashRate", ("1", "a", "33", "ID", "0.5"), ("1", None, "33", "ID", "0.1"))),
              "stg_play_console_crash_rate"),
        stage(raw(health_rows("anrRate", ("1", "a", "33", "ID", "0.25"), ("2", "a", "33", "ID", "1"))),
              "stg_play_console_anr_rate"),
        stage(raw(health_rows("stuckBgWakelockRate", ("2", "a", "33", "ID", "x"))),
              "stg_play_console_stuck_bg_wakelock_rate"),
        stage(raw(health_rows("excessiveWakeupRate", ("1", None, "33", "ID", "0.75"))),
              "stg_play_console_excessive_wakeup_rate"),
    ]
    health = android_store.app_health(*inputs)
    assert plan_of(health).count("Exchange") == 4  # one per staging table, none for the merge
    found = [
        (r["version_code"], r["device_model"], r["crash_rate"], r["anr_rate"],
         r["excessive_wakeup_rate"])
        for r in as_dicts(health, "version_code", "device_model", "crash_rate")
    ]
    assert found == [
        (1, "a", 0.5, 0.25, None), (1, None, 0.1, None, None), (1, None, None, None, 0.75),
        (2, "a", None, 1.0, None),
    ]
    devices = as_dicts(dashboards.by_os_version(health))
    assert [(r["os_version"], r["data_points"], r["avg_crash_rate"]) for r in devices] == [
        ("33", 4, pytest.approx(0.3))
    ]


def test_store_stats_and_android_overview(spark, raw):
    daily = stage(raw([{"date": "2026-06-01", "daily_device_installs": "5"}]),
                  "stg_play_console_gcs_installs")
    traffic = stage(raw([
        {"date": "2026-06-01", "country___region": "ID", "store_listing_acquisitions": "1",
         "store_listing_visitors": "10"},
        {"date": "2026-06-01", "country___region": "SG", "store_listing_acquisitions": "2",
         "store_listing_visitors": "2"},
        {"date": "2026-06-02", "country___region": "ID", "store_listing_acquisitions": "2",
         "store_listing_visitors": "0"},
    ]), "stg_play_console_gcs_store_performance")
    crashes = stage(raw([{"date": "2026-06-03", "daily_crashes": "3", "daily_anrs": ""}]),
                    "stg_play_console_gcs_crashes")
    store = android_store.store_stats(daily, traffic, crashes)
    one, two, three = as_dicts(store, "date")
    assert (one["daily_device_installs"], one["store_listing_conversion_rate"]) == (5, 0.25)
    assert (two["store_listing_acquisitions"], two["store_listing_conversion_rate"]) == (2, None)
    assert (three["daily_crashes"], three["daily_anrs"], three["platform"]) == (3, None, "android")

    reviews = android_store.reviews(stage(raw([
        {"review_id": str(n), "star_rating": s, "last_modified_seconds": "1780272000",
         "developer_reply_text": "", "developer_reply_seconds": ""}
        for n, s in enumerate(["1", "2", "5", ""])
    ]), "stg_play_console_reviews"))
    health = android_store.app_health(*[
        stage(raw(health_rows(rate, ("1", "a", "33", "ID", "0.5"))), name) for rate, name in (
            ("crashRate", "stg_play_console_crash_rate"), ("anrRate", "stg_play_console_anr_rate"),
            ("stuckBgWakelockRate", "stg_play_console_stuck_bg_wakelock_rate"),
            ("excessiveWakeupRate", "stg_play_console_excessive_wakeup_rate"),
        )
    ])
    rows = as_dicts(dashboards.overview_android(health, reviews, store), "date")
    first = rows[0]
    assert (first["total_reviews"], first["negative_reviews"]) == (4, 2)
    assert first["avg_rating"] == pytest.approx(8 / 3)
    assert (first["avg_crash_rate"], first["daily_device_installs"]) == (0.5, 5)
    assert (rows[2]["total_reviews"], rows[2]["avg_rating"], rows[2]["daily_crash_count"]) == (0, None, 3)


# ---- iOS store ----


def ios(table_name, raw, *rows):
    return stage(raw([{"date": "2026-06-01", **r} for r in rows]), table_name)


def test_ios_acquisition_engagement_and_overview(raw):
    downloads = ios(
        "stg_appstore_app_downloads", raw,
        {"download_type": "First-time download", "app_version": "1", "counts": "10"},
        {"download_type": "Redownload", "app_version": "1", "counts": "4"},
        {"download_type": "Restore", "app_version": "2", "counts": "1"},
    )
    discovery = ios(
        "stg_appstore_app_discovery_engagement", raw,
        {"event": "Impression", "page_type": "x", "counts": "100"},
        {"event": "Page view", "page_type": "Product page", "counts": "7"},
        {"event": "Page view", "page_type": "Store sheet", "counts": "8"},
        {"event": "Tap", "page_type": "Product page", "counts": "3"},
        {"event": "Tap", "date": "2026-06-02", "counts": "3"},
    )
    acquisition = ios_store.acquisition(downloads, discovery)
    one, two = as_dicts(acquisition, "date")
    assert (one["app_units"], one["total_downloads"], one["product_page_views"]) == (14, 15, 7)
    assert (one["conversion_rate"], two["conversion_rate"], two["app_units"]) == (0.1, None, 0)

    changes = ios(
        "stg_appstore_app_installs_deletions", raw,
        {"event": "Install", "counts": "9", "unique_devices": "8"},
        {"event": "Delete", "counts": "2", "unique_devices": "2"},
    )
    sessions = ios(
        "stg_appstore_app_sessions", raw,
        {"app_version": "1", "device": "iPhone", "sessions": "6", "total_session_duration": "60",
         "unique_devices": "3"},
        {"app_version": "3", "device": None, "sessions": "1", "total_session_duration": "5",
         "unique_devices": "1"},
        {"date": "2026-06-03", "sessions": "0", "total_session_duration": "1", "unique_devices": "0"},
    )
    engagement = ios_store.engagement(changes, sessions)
    first, last = as_dicts(engagement, "date")
    assert (first["installs"], first["deletions"], first["active_devices"]) == (9, 2, 8)
    assert (first["sessions_per_device"], first["avg_session_duration"]) == (7 / 4, 65 / 7)
    assert (last["installs"], last["avg_session_duration"]) == (0, None)

    versions = as_dicts(dashboards.by_app_version(downloads, sessions), "date", "app_version")
    assert [(r["app_version"], r["total_downloads"], r["sessions"]) for r in versions[:3]] == [
        ("1", 14, 6), ("2", 1, 0), ("3", 0, 1)
    ]

    reviews = ios_store.reviews(stage(raw([
        {"review_id": "1", "rating": "2", "created_date": "2026-06-02T03:00:00+07:00"},
        {"review_id": "2", "rating": "", "created_date": "2026-06-04T10:00:00+07:00"},
    ]), "stg_appstore_reviews"))
    performance = ios(
        "stg_appstore_app_install_performance", raw,
        {"install_status": "Success", "counts": "3"}, {"install_status": "Failure", "counts": "1"},
        {"install_status": "Pending", "counts": "100"},
    )
    rows = as_dicts(dashboards.overview_ios(acquisition, engagement, reviews, performance), "date")
    assert [r["date"] for r in rows] == [day(1), day(2), day(3), day(4)]
    assert (rows[0]["crash_rate"], rows[0]["total_install_attempts"]) == (0.25, 4)
    assert (rows[0]["net_installs"], rows[0]["total_reviews"], rows[0]["negative_reviews"]) == (7, 1, 1)
    assert (rows[1]["installs"], rows[1]["net_installs"]) == (0, None)
    assert (rows[3]["total_reviews"], rows[3]["avg_rating"]) == (1, None)


def test_rating_tables(raw):
    android = android_store.reviews(stage(raw([
        {"review_id": str(n), "star_rating": s, "last_modified_seconds": "1780272000",
         "developer_reply_text": "", "developer_reply_seconds": ""}
        for n, s in enumerate(["1", "1", "5", ""])
    ]), "stg_play_console_reviews"))
    ios_reviews = ios_store.reviews(stage(raw([
        {"review_id": str(n), "rating": s, "created_date": "2026-06-01T10:00:00Z"}
        for n, s in enumerate(["4", "4", ""])
    ]), "stg_appstore_reviews"))
    shares = as_dicts(dashboards.rating_distribution(android, ios_reviews), "platform", "rating")
    assert [(r["platform"], r["rating"], r["review_count"], r["total_reviews"], r["pct"]) for r in shares] == [
        ("android", 1, 2, 4, 0.5), ("android", 5, 1, 4, 0.25), ("android", None, 1, 4, 0.25),
        ("ios", 4, 2, 2, 1.0),
    ]
    daily = as_dicts(dashboards.ratings_daily(android, ios_reviews), "platform")
    assert [(r["platform"], r["review_count"], r["rating_1"], r["rating_4"]) for r in daily] == [
        ("android", 4, 2, 0), ("ios", 3, 0, 2)
    ]


def test_devices_of_both_platforms(raw):
    health = android_store.app_health(*[
        stage(raw(health_rows(rate, ("1", "a", "33", "ID", "0.5"), ("1", None, "33", "ID", "1"))), name)
        for rate, name in (
            ("crashRate", "stg_play_console_crash_rate"), ("anrRate", "stg_play_console_anr_rate"),
            ("stuckBgWakelockRate", "stg_play_console_stuck_bg_wakelock_rate"),
            ("excessiveWakeupRate", "stg_play_console_excessive_wakeup_rate"),
        )
    ])
    sessions = ios("stg_appstore_app_sessions", raw,
                   {"device": "iPhone", "sessions": "6", "unique_devices": "3"},
                   {"device": None, "sessions": "1", "unique_devices": "1"})
    rows = as_dicts(dashboards.by_device(health, sessions), "platform")
    assert [(r["platform"], r["device"], r["avg_crash_rate"], r["sessions"], r["data_points"]) for r in rows] == [
        ("android", "a", 0.5, None, 1), ("ios", "iPhone", None, 6, 1)
    ]


# ---- whole chains ----


def test_lazy_chain_from_raw(spark, raw):
    name = raw_name("stg_appsflyer_campaign_performance")
    df = table("mart_appsflyer_campaign_performance", {name: raw([cost()])}, spark)
    # type, keep the latest, group by the same keys: one shuffle
    assert plan_of(df).count("Exchange") == 1
    assert df.first()["ctr"] == 0.01
