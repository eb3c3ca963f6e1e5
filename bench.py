"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local threads,
BENCH_REPEATS how often each query runs (the best time counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "customer_360", "account_analytics", "transaction_analytics", "cash_advance_analytics", "direct_deposit_analytics",
    "fraud_risk_daily", "customer_churn_risk", "campaign_performance", "compliance_risk", "txn_pattern_aggs",
    "fraud_detection_aggs", "txn_velocity_30d", "risk_indicators", "detect_anomalies", "feature_store_health",
    "feature_drift_monitor", "business_metrics", "platform_comparison", "compute_batch_features", "feature_stats",
    "training_dataset", "join_asof", "win_lag", "win_running_sum", "agg_percentiles", "topk_per_group",
    "sv_customer_banking", "sv_transaction_payment", "sv_credit_risk", "search_topk", "vector_topk", "train_set_fraud",
    "score_transaction_risk", "q_attribution", "q_aml_patterns", "q_fraud_24h", "backfill", "check_unique_key",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))

    from kontora.queries import catalog
    from kontora.session import build_session

    spark = build_session(
        "kontora-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.sql.warehouse.dir": "/tmp/kontora-warehouse"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    spark.read.parquet(f"{folder}/events.parquet").count()  # start the JVM's readers before timing
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeats):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
