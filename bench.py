"""Time headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` an
optional comma-separated choice. Each query writes its full result to the no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from waymark.queries import QUERIES
from waymark.session import local_session

HEADLINE = [
    "last_touch",
    "page_visit_fact",
    "page_sequence",
    "session_conversions",
    "new_vs_returned",
    "channel_rules_v1",
    "channel_rules_v3",
    "cta_flags",
    "near_event_join",
    "asof_fallback",
    "org_person_map",
    "member_base",
    "inquiry_fact",
    "dashboard_merge",
    "monthly_kpis",
    "cohort_touch_nearest",
    "lookback_30d",
    "linear_credit",
    "credit_on_activation",
    "campaign_touchset",
    "channel_rules_v2",
    "inbound_wide",
    "paid_performance",
    "activity_enrich",
    "earliest_assist",
    "global_order",
    "burn_down",
    "grain_check",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "bench")
    # Not timed: starts the JVM's compilers on the smallest query of the kind.
    QUERIES["grain_check"](spark, folder).count()
    QUERIES["nearest_events"](spark, folder).count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
