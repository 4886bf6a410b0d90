"""Wall time of the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times (default 3); the best counts. A
run covers building the DataFrame, planning and computing every row and column; ``planning`` is
the first two.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from creditflow.plans import catalog
from creditflow.session import local_session

HEADLINE = [
    "request_routing",
    "loan_decision",
    "decision_analytics",
    "window_metrics",
    "notification_metrics",
    "metrics_pivot",
    "dash_latest",
    "dash_trend_30s",
    "dash_daily",
    "stage_latency",
    "npl_inputs_union",
    "upsert_income",
    "upsert_npl_income",
    "upsert_npl_request",
    "upsert_loan",
    "outbox_pending_npl",
    "outbox_mark_sent",
    "outbox_anti",
    "event_counter",
    "json_request_parse",
    "json_request_write",
    "payload_profile",
    "loan_report",
    "newest_100",
    "latest_by_source",
    "npl_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("creditflow-bench", cores=cores)
    queries = catalog.registered()

    def once(name: str) -> tuple[float, float]:
        """Seconds in all, and of them for building and planning the query."""
        start = time.perf_counter()
        df = queries[name](spark, folder)
        df._jdf.queryExecution().executedPlan()
        planned = time.perf_counter() - start
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start, planned

    best, median, planning = {}, {}, {}
    for name in HEADLINE:
        once(name)
        times = [once(name) for _ in range(runs)]
        best[name] = round(min(t for t, _ in times), 3)
        median[name] = round(statistics.median(t for t, _ in times), 3)
        planning[name] = round(min(p for _, p in times), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best times",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "median": median,
                "planning": planning,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
