"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local cores.
Each query is run whole into a no-op sink, the best of BENCH_REPEAT runs counts. ``qa_summary`` reads tables that
are loaded once; ``setup`` has the time of that load, which is not part of any query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from usertide.session import get_session  # noqa: E402
from workload.queries import queries, stored_model  # noqa: E402

HEADLINE = [
    "stg_events_enriched",
    "event_slices",
    "dim_date",
    "dim_device",
    "dim_geo",
    "dim_traffic_source",
    "dim_user",
    "fact_sessions",
    "fact_funnel_steps",
    "fact_user_daily_activity",
    "fact_purchases",
    "mrt_funnel_daily",
    "mrt_retention_cohorts",
    "mrt_retention_curve",
    "mrt_churn_proxy",
    "mrt_wow_kpis",
    "load_full",
    "load_incremental",
    "incremental_fact_sessions",
    "qa_duplicates_fact_sessions",
    "qa_nulls_fact_sessions",
    "qa_orphans_geo",
    "qa_step_ordering",
    "qa_reconcile",
    "qa_purchase_grain",
    "qa_summary",
    "activated_users",
    "step_conversion",
    "active_users_week",
    "retention_nday",
    "churn_rate_30d",
    "churn_sensitivity",
    "profile_events",
    "funnel_by_device",
    "new_vs_returning",
    "dedup_events",
    "sessionize_gap",
    "session_start_resolved",
    "daily_activity_reporting_tz",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = queries()
    found["mrt_funnel_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    start = time.perf_counter()
    stored_model(spark, sf_dir)
    setup = {"load_for_qa_summary": round(time.perf_counter() - start, 3)}
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeat):
            start = time.perf_counter()
            found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    spark.stop()
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "setup": setup,
                "sf": float(sf.group(1)) if sf else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
