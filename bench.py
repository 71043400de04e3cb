"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the cores of the local session. Every query
runs once to warm the JVM and then ``BENCH_RUNS`` times; the best run counts. Results go to Spark's
no-op sink, so whole results are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallymart.plans import QUERIES  # noqa: E402
from tallymart.session import local_session, scratch  # noqa: E402

HEADLINES = [
    "sales_by_city",
    "sales_by_loyalty",
    "orders_with_clients",
    "customer_activity",
    "regional_activity",
    "churn_features",
    "churn_by_region",
    "clean_transactions",
    "clean_customers",
    "transaction_cleaning_stats",
    "quality_report",
    "customer_base",
    "median_thresholds",
    "composite_risk",
    "risk_by_nation",
    "scaled_features",
    "breakdowns",
    "new_vs_returning",
    "correlations",
    "column_profile",
    "amount_outliers",
    "spike_days",
    "stratified_split",
    "class_report",
    "roc_points",
    "auc",
    "churn_model_metrics",
    "segment_profile",
    "anomaly_profile",
    "smote_counts",
    "risk_model_metrics",
    "cv_scores",
    "forest_importance",
    "metrics_summary",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINES
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        with scratch():
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def calibration() -> float:
        """Seconds of a job that no round changes, so that figures of different machines can be compared."""
        start = time.perf_counter()
        spark.range(300_000_000).selectExpr("sum(pmod(xxhash64(id), 1000)) AS s").write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    calibration()
    fixed = round(min(calibration() for _ in range(3)), 3)
    seconds = {}
    for name in chosen:
        once(name)
        seconds[name] = round(min(once(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "calibration": fixed,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
