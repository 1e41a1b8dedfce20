"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local threads. Every query is run in full
into a sink that drops the rows. The smallest tables are run first, untimed: they compile the
same code, so that the timed run measures the data and not the compiler.
"""

from __future__ import annotations

import json
import os
import time

from appkpi.session import get_spark
from workloads.queries import QUERIES

HEADLINE = (
    "campaign_performance",
    "cost_ratios",
    "keep_latest_events",
    "safe_casts",
    "event_category",
    "json_scalar_props",
    "daily_full_outer",
    "order_retention",
    "flatten_metric_rows",
    "land_csv",
    "dq_report",
    "mart_appsflyer_fraud",
    "mart_appsflyer_retention",
    "mart_appsflyer_user_quality",
    "mart_moengage_push",
    "mart_moengage_campaign_analytics",
    "mart_play_console_app_health",
    "mart_play_console_gcs_stats",
    "mart_play_console_reviews",
    "mart_appstore_acquisition",
    "mart_appstore_engagement",
    "dash_acquisition_by_app_version",
    "dash_acquisition_by_device",
    "dash_acquisition_by_os_version",
    "dash_overview_android",
    "dash_overview_ios",
    "dash_rating_distribution",
    "dash_ratings_daily",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = get_spark(
        "appkpi-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    warm_up = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_up):
        for name in names:
            run(name, warm_up)
    seconds = {name: round(run(name, sf_dir), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
