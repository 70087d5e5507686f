"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the data and the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from listingguard.plans import catalog  # noqa: E402
from listingguard.session import local_session  # noqa: E402

HEADLINE = (
    "fraud_labels",
    "label_holdout",
    "rule_contribution",
    "dedup_listings",
    "missing_profile",
    "describe_numeric",
    "price_profile",
    "top_values",
    "histogram_by_label",
    "fraud_by_city",
    "correlation_matrix",
    "mann_whitney",
    "ppsf_top_cities",
    "stateless_features",
    "fold_features",
    "standard_scale",
    "stratified_sample",
    "group_folds",
    "evaluate_models",
    "threshold_sweep",
    "calibration_error",
    "top3_explanations",
    "explain_insights",
    "drift_cities",
    "history_page",
    "fraud_stats",
    "latency_percentiles",
    "retrieve_topn",
    "tfidf_weights",
)


def run(spark, d: str, name: str) -> float:
    start = time.time()
    catalog.queries()[name](spark, d).write.format("noop").mode("overwrite").save()
    return round(time.time() - start, 3)


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    times: dict[str, float] = {}
    # Stage tables, as the batch pipeline writes them once: ingest, label, log.
    for name, build in (
        ("stage_ingest", catalog.listings),
        ("stage_label", catalog.labeled),
        ("stage_log", catalog.prediction_log),
    ):
        start = time.time()
        build(spark, d)
        times[name] = round(time.time() - start, 3)
    for name in HEADLINE:
        times[name] = run(spark, d, name)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(d.rstrip("/")).replace("sf", ""),
            }
        )
    )


if __name__ == "__main__":
    main()
